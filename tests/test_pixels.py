import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.functions import pixels as P
from quire.sources import recognize as R

MASKS = st.integers(1, 9).flatmap(lambda w: st.lists(st.lists(st.booleans(), min_size=w, max_size=w), min_size=1, max_size=9)).map(np.array)


def slow_components(mask):
    left = {(int(y), int(x)) for y, x in zip(*np.nonzero(mask), strict=True)}
    out = []
    while left:
        todo, area = [left.pop()], []
        while todo:
            y, x = todo.pop()
            area.append((y, x))
            near = {(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
            left -= near
            todo += near
        ys, xs = zip(*area, strict=True)
        out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(area)))
    return sorted(out)


@settings(max_examples=200, deadline=None)
@given(MASKS)
def test_components_touch_at_corners(mask):
    assert sorted(P.components(mask)) == slow_components(mask)


@settings(max_examples=50, deadline=None)
@given(MASKS, st.integers(1, 4))
def test_long_runs(mask, least):
    want = [["".join("1" if c else "0" for c in row)] for row in mask]
    want = np.array([[c == "1" for c in "".join(part if len(part) >= least or "0" in part else "0" * len(part) for part in __import__("re").findall("1+|0+", row[0]))] for row in want])
    assert (P.long_runs(mask, least) == want).all()


def test_speckle_and_ink():
    rng = np.random.default_rng(3)
    image = rng.integers(0, 256, (9, 7, 3), dtype=np.uint8)
    for y, x in ((0, 0), (4, 3), (8, 6)):
        ys, xs = np.clip([y - 1, y, y + 1], 0, 8), np.clip([x - 1, x, x + 1], 0, 6)
        assert (P.denoise(image)[y, x] == np.median(image[np.ix_(ys, xs)].reshape(9, 3), axis=0)).all()
    two = np.where(rng.random((40, 40)) < 0.3, 60, 200).astype(np.uint8)
    assert (P.binarize(two) == np.where(two > 100, 255, 0)).all() and P.grey(two) is two
    assert P.denoise(two).shape == two.shape and P.grey(image).shape == (9, 7)


@pytest.mark.parametrize("angle", [-4.0, 0.0, 3.0])
def test_skew_is_found_and_undone(angle):
    h, w = 200, 300
    y, x = np.mgrid[0:h, 0:w]
    a = np.radians(angle)
    u, v = (x - w / 2) * np.cos(a) + (y - h / 2) * np.sin(a), -(x - w / 2) * np.sin(a) + (y - h / 2) * np.cos(a)
    image = np.where((abs(u) < 100) & (abs(v) < 40), 0, 255).astype(np.uint8)
    assert P.skew(image) == pytest.approx(angle, abs=0.5)
    level, turned, matrix = P.deskewed(image)
    assert abs(P.skew(level)) < 0.7 and (turned == 0) == (angle == 0)
    corner = np.array([-100 * np.cos(a) + 40 * np.sin(a) + w / 2, -100 * np.sin(a) - 40 * np.cos(a) + h / 2, 1])
    assert np.array(matrix).reshape(2, 3) @ corner == pytest.approx([w / 2 - 100, h / 2 - 40], abs=2)


def test_skew_bounds():
    assert [P.applies(a) for a in (0.05, 0.1, -15, 15.1, 0)] == [False, True, True, False, False]
    assert P.skew(np.full((5, 5), 255, np.uint8)) == 0


def drawn(ys, xs, h=240, w=320, skip=()):
    image = np.full((h, w), 255, np.uint8)
    for y in ys:
        image[y : y + 2, xs[0] : xs[-1] + 2] = 0
    for k, x in enumerate(xs):
        for a, b in zip(ys, ys[1:], strict=False):
            if (a, k) not in skip:
                image[a : b + 2, x : x + 2] = 0
    return image


def test_ruled_tables():
    (table,) = P.table_grids(drawn([20, 70, 120], [30, 130, 230, 300]))
    assert (table["n_rows"], table["n_cols"], len(table["cells"])) == (2, 3, 6) and table["box"] == (30, 20, 272, 102)
    assert {c[:4] for c in table["cells"]} == {(r, c, r + 1, c + 1) for r in range(2) for c in range(3)}
    (merged,) = P.table_grids(drawn([20, 70, 120], [30, 130, 230, 300], skip={(20, 1)}))
    assert (0, 0, 1, 2) in {c[:4] for c in merged["cells"]} and len(merged["cells"]) == 5
    assert P.table_grids(drawn([20, 120], [30, 300])) == [] and P.table_grids(np.full((50, 50), 255, np.uint8)) == []


def test_boxes_of_a_page():
    image = drawn([20, 70, 120], [30, 130, 230, 300])
    words = {"text": ["a", " ", "b", "c"], "conf": ["90", "80", "-1", 70], **{c: [1, 1, 1, 2] for c in ("block_num", "par_num", "line_num")}, "left": [40, 0, 0, 5], "top": [30, 0, 0, 200], "width": [20] * 4, "height": [10] * 4}
    R.register_engine("tesseract", lambda image, langs: R.words_of_table(words))
    try:
        boxes = R.detect_boxes(image, "tesseract", ["en"])
        assert [b["category"] for b in boxes] == ["table", "text"] and boxes[1]["y"] == 200  # the word in the table goes
        assert [b["category"] for b in R.detect_boxes(image, "none", [])] == ["table", "text"]
        made = R.recognize_table(image, boxes[0], "cv", lambda crop: f" {crop.shape[0]} \n px ")
        assert made["html"].count("<td>48 px</td>") == 6 and made["n_cols"] == 3 and len(made["cell_boxes"]) == 6
        assert R.recognize_table(image, boxes[0], "none", str) == {"flags": ["provider_disabled"]}
    finally:
        R.ENGINES.clear()
    for wrong in (lambda: R.engine("x"), lambda: R.detect_boxes(image, "x", [])):
        with pytest.raises(R.UnknownName):
            wrong()


def test_results_of_engines():
    ring = [(10, 24), (30, 24), (30, 40), (10, 40)]
    for result in ([{"rec_polys": [ring], "rec_texts": ["hi"], "rec_scores": [0.5]}], [[(ring, ("hi", 0.5))]]):
        assert R.words_of_detections(R.detections_of_pages(result)) == [{"pos": 0, "text": "hi", "confidence": 50.0, "line_key": [2, 10], "x": 10, "y": 24, "w": 20, "h": 16}]
    assert R.detections_of_pages([None]) == [] == R.detections_of_pages(None)


def test_steps_on_arrays():
    image = np.full((30, 40, 3), 255, np.uint8)
    made, geometry = R.preprocess(image, {"dpi": 300}, ("deskew", "denoise", "grayscale", "binarize"), R.STEPS)
    assert made.shape == (30, 40) and geometry == {"dpi": 300}
