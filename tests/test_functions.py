import random
import re
import time
from functools import cache
from itertools import groupby

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions import alignment as A
from quire.functions import geometry as G
from quire.functions import normalize as N
from quire.functions import tables as Tb
from quire.operators.assemble import xy_cut
from quire.operators.metrics import rising_pairs

MARK = "<!-- image -->"


def slow_gap(words, tokens):
    """(errors, ignored) of the cheapest way to read words as tokens, where a mark takes any words; every cell by itself."""
    best = {(0, 0): (0, 0)}
    for i in range(len(words) + 1):
        for j in range(len(tokens) + 1):
            ways = [best[0, 0]] if i == j == 0 else []
            mark = j and tokens[j - 1] == N.IMAGE_MARK
            if j:
                e, g = best[i, j - 1]
                ways.append((e + (not mark), g))
            if i:
                e, g = best[i - 1, j]
                ways.append((e, g + 1) if mark else (e + 1, g))
            if i and j and not mark:
                e, g = best[i - 1, j - 1]
                ways.append((e + (words[i - 1] != tokens[j - 1]), g))
            best[i, j] = min(ways)
    return best[len(words), len(tokens)]


WORDS = st.lists(st.sampled_from("ash birch cedar".split()), max_size=7)


@settings(max_examples=200, deadline=None)
@given(WORDS, st.lists(st.sampled_from(["ash", "birch", "cedar", N.IMAGE_MARK]), max_size=7))
def test_gaps_against_every_alignment(words, tokens):
    assert A.with_wildcards(words, tokens) == slow_gap(words, tokens)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("ash birch cedar".split()), max_size=2), st.lists(WORDS, min_size=2, max_size=4))
def test_marks_take_what_stands_in_their_place(noise, parts):
    """A prediction that says something else where images are has no errors, and ignores just that."""
    parts = [[f"{w}{k}x{n}" for n, w in enumerate(part)] + [f"end{k}", f"of{k}", f"part{k}"] for k, part in enumerate(parts)]
    gold = f" {MARK} ".join(" ".join(p) for p in parts)
    predicted = f" {' '.join(noise)} ".join(" ".join(p) for p in parts)
    n_words = sum(map(len, parts))
    assert A.wer_counts(predicted, gold) == (0, n_words, len(noise) * (len(parts) - 1))
    wrong = predicted.replace("of1", "xx")
    errors, n, _ = A.wer_counts(wrong, gold)
    assert n == n_words and errors >= slow_gap(N.strict_text(wrong).split(), N.strict_text(N.marked_text(gold)).split())[0] >= 1


@pytest.mark.parametrize(("predicted", "gold"), [
    ("rivers ![ice](i.png) freeze early in [hình: snow] cold years", "rivers freeze early in cold years"),
    ("rivers thaw early", "rivers freeze early in cold years"), ("", "some words here"), ("a b c d", "d c b a"),
    ("**rivers** freeze\n\n# early", "rivers freeze early"),
])
def test_word_errors_without_marks(predicted, gold):
    words, tokens = N.strict_text(predicted).split(), N.strict_text(gold).split()
    assert A.wer_counts(predicted, gold) == (slow_distance(words, tokens), len(tokens), 0)


@pytest.mark.parametrize("gold", ["", " \n ", MARK, "![ice](i.png) [hình: snow]"])
def test_nothing_to_score(gold):
    assert A.wer_counts("rivers freeze", gold) is None


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", max_size=14), st.text("abcd", max_size=14))
def test_alignment_is_optimal(a, b):
    runs = A.operations(a, b)
    assert A.levenshtein(a, b) == slow_distance(a, b) == sum(max(i2 - i1, j2 - j1) for k, i1, i2, j1, j2 in runs if k != "equal")
    assert all(a[i1:i2] == b[j1:j2] for k, i1, i2, j1, j2 in runs if k == "equal")
    assert [r[1] for r in runs[1:]] == [r[2] for r in runs[:-1]]


def test_long_alignment_crosses_blocks():
    rng = random.Random(3)
    a = "".join(rng.choice("ab c") for _ in range(1500))
    b = "".join(c for c in a if rng.random() > 0.1) + "zz"
    assert sum(max(i2 - i1, j2 - j1) for k, i1, i2, j1, j2 in A.operations(a, b) if k != "equal") == A.levenshtein(a, b)


def slow_steps(a, b):
    """The rule of `steps` on the whole table of distances."""
    head = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    x, y = a[head:], b[head:]
    table = [[slow_distance(x[:i], y[:j]) for j in range(len(y) + 1)] for i in range(len(x) + 1)]
    out, i, j = [], len(x), len(y)
    while i and j:
        same, less = x[i - 1] == y[j - 1], table[i][j] - 1
        kind = 0 if same else 1 if table[i - 1][j - 1] == less else 2 if table[i - 1][j] == less else 3
        out.append(kind)
        i, j = i - (kind != 3), j - (kind != 2)
    return [0] * head + (out + [2] * i + [3] * j)[::-1]


@pytest.mark.parametrize("block", [1, 3])
def test_narrow_bands_keep_the_rule(monkeypatch, block):
    """Bands that start too narrow, windows of few rows: the steps are those of the whole table, for texts and for lists."""
    monkeypatch.setattr(A, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(300):
        a = "".join(rng.choice("ab\U0001f600") for _ in range(rng.randrange(13)))
        b = rng.choice([a[4:] + a[:4], a.replace("a", "b"), "".join(rng.choice("ab ") for _ in range(rng.randrange(13)))])
        assert A.steps(a, b).tolist() == A.steps(list(a), list(b)).tolist() == slow_steps(a, b), (a, b)


@pytest.mark.parametrize("read", [lambda rng, c: "m" if c == "n" else c, lambda rng, c: rng.choice(["", "x", c + "x"]) if rng.random() < 0.005 else c])
def test_long_page_is_aligned_in_its_own_length(read):
    """Half a million characters; bit vectors as long as the text took the square of that, minutes here."""
    rng = random.Random(5)
    gold = "\n".join("".join(rng.choice("abcde nop") for _ in range(60)) + "." for _ in range(8000))
    lines = "".join(read(rng, c) if c != "\n" else c for c in gold).split("\n")
    began = time.process_time()
    made = A.labelled_lines(lines, gold)
    assert time.process_time() - began < 30
    assert [x[0] for x in made].count(None) < 8000 * 0.01
    for line, (label, like, _) in list(zip(lines, made, strict=True))[::400]:
        assert label is None or like == 1 - slow_distance(line, label) / max(len(line), len(label))


@pytest.mark.parametrize(("second", "first"), list(N.tone_pairs().items()))
def test_tones_move_to_the_first_vowel(second, first):
    q = "Q" if second[0].isupper() else "q"
    assert N.traditional_tones(f"{second} x{second}, {second}n") == f"{first} x{first}, {second}n"
    assert N.traditional_tones(q + second) == q + (second if second[0] in "uU" else first)


def test_there_are_45_tone_pairs():
    assert len(N.tone_pairs()) == 45 and all(len(a) == len(b) == 2 and a != b for a, b in N.tone_pairs().items())


@pytest.mark.parametrize(("text", "expected"), [
    ("<!-- ann:7 -->\n### Rain\n\n+ one drop\n12. **two**", "Rain one drop two"), ("![x](y) z", "z"), ("<table><tr><td>1</td><td>2</td></tr></table>", "1 2"),
    ("5 km<sup>2</sup> of CO<sub>2</sub>", "5 km2 of CO2"), ("<i>half</i>way <br/>on", "halfway on"), ("salt &amp; pepper &lt;x&gt;", "salt & pepper <x>"),
    ("[hình: rain] after [link](to)", "after link"), ("- # kept", "# kept"), ("e\u0301t\u00a0e\u0301", "\u00e9t \u00e9"),
])
def test_strict(text, expected):
    assert N.strict_text(text) == expected


def test_references_without_a_semicolon():
    """HTML's old names need none; the closed reading, which SQL has, leaves them."""
    for text, closed, html in (("R&amp</p>", "R&amp", "R&"), ("&ampx; &amp;amp; &copy", "&ampx; &amp; &copy", "&x; &amp; ©"), ("&quot;a&#33;&#x22;&middot;&no;", '"a!"·&no;', '"a!"·&no;')):
        assert N.closed_references(text.replace("</p>", "")) == N.strict_text(text, N.closed_references) == closed and N.strict_text(text) == html


def test_column_steps_agree_with_strict(spark):
    rows = [("# a\n- b <b>c</b> [d](e) <p>f</p>  g<!-- x\ny -->",), ("![p](q) [HÌNH: r] s_t*",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    native = N.flatten(N.drop_line_marks(N.drop_tags(N.drop_figures(F.col("t")))))
    for a, b in df.select(native, N.strict("t")).collect():
        assert a == b


def test_label_preparation():
    assert N.label_text("<table><tr><td>x</td></tr></table>hoà\n- a\n* b\n+ c\n1. First\na) letter") == "hoà\na\nb\nc\n1. First\na) letter"


@settings(max_examples=150, deadline=None)
@given(st.text("ab c", max_size=12), st.text("ab c", max_size=12))
def test_offsets_follow_the_alignment(ocr, gold):
    to = A.offset_map(ocr, gold).tolist()
    assert len(to) == len(ocr) + 1 and to[-1] == len(gold) and to == sorted(to)
    for kind, a0, a1, b0, b1 in A.operations(ocr, gold):
        share = (b1 - b0) / (a1 - a0) if a1 > a0 else 0
        assert all(to[a0 + k] == b0 + round(share * k) for k in range(a1 - a0)), kind


def test_line_labels():
    assert [x[0] for x in A.labelled_lines(["rain fa1ls", "on the hi11s"], "rain falls\non the hills")] == ["rain falls", "on the hills"]
    (label, like, reason), *_ = A.labelled_lines(["qqqqqqqq"], "nothing of that kind")
    assert label is None and like < 0.7 and reason == f"similarity {like:.3f} < 0.7"
    assert A.labelled_lines(["a", "b"], " ") == [(None, None, "empty ocr or ground truth")] * 2 == A.labelled_lines(["", " "], "x")
    assert A.labelled_lines(["rain", "xx"], "rain")[1] == (None, None, "empty gt span")
    assert A.labelled_lines(["rain", " ", "hail"], "rain\n \nhail")[1] == (" ", 1.0, None)  # blank spans are scored like others


def as_tree(node):
    return node.tag, node.colspan, node.rowspan, node.text, tuple(map(as_tree, node.children))


def slow_trees(a, b):
    """The edit distance of two forests by taking off their last roots in every way."""
    size = lambda forest: sum(1 + size(n[4]) for n in forest)

    @cache
    def least(x, y):
        if not x or not y:
            return float(size(x) + size(y))
        (*restx, u), (*resty, v) = x, y
        restx, resty = tuple(restx), tuple(resty)
        cost = 1.0
        if u[:3] == v[:3]:
            cost = slow_distance(u[3], v[3]) / max(len(u[3]), len(v[3]), 1) if u[0] == "td" else 0.0
        return min(least((*restx, *u[4]), y) + 1, least(x, (*resty, *v[4])) + 1, least(u[4], v[4]) + least(restx, resty) + cost)

    return least((a,), (b,))


CELL = st.builds(lambda text, span: f"<td{span}>{text}</td>", st.text("rye oat", max_size=3), st.sampled_from(["", ' colspan="2"', ' rowspan="3"']))
TABLES = st.lists(st.lists(CELL, max_size=3).map(lambda r: f"<tr>{''.join(r)}</tr>"), max_size=3).map(lambda rows: f"<table>{''.join(rows)}</table>")


@settings(max_examples=100, deadline=None)
@given(TABLES, TABLES)
def test_table_similarity(a, b):
    x, y = Tb.tree_of(a), Tb.tree_of(b)
    want = max(0.0, 1 - slow_trees(as_tree(x), as_tree(y)) / max(Tb.count_nodes(x), Tb.count_nodes(y)))
    assert Tb.teds(x, y) == pytest.approx(want) == Tb.teds(y, x)


def test_loose_markup_gives_the_same_tree():
    plain = "<table><tr><td>field</td><td>rye</td></tr><tr><td>north</td><td>4</td></tr></table>"
    for other in ("<table><tr><td>field<td>rye<tr><td>north<td>4</table>", "<table><thead><tr><th>field</th><th>rye</th></tr></thead><tbody><tr><td>north</td><td>4</td></tr></tbody></table>"):
        assert as_tree(Tb.tree_of(other)) == as_tree(Tb.tree_of(plain))


@pytest.mark.parametrize(("line", "cells"), [("| a | b |", ["a", "b"]), ("|a|b", ["a", "b"]), ("a | b |", ["a", "b"]), ("|", [""]), ("||", [""]), ("|a||", ["a", ""]), ("| x\\|y | z\\|", ["x|y", "z|"]), ("  | \\| |  ", ["|"])])
def test_pipe_cells(line, cells):
    assert Tb.pipe_cells(line) == cells


def test_table_extraction():
    pipe = "| field | yield |\n|:---|---:|\n| north | 4 < 5 |"
    made = "<table><tr><th>field</th><th>yield</th></tr><tr><td>north</td><td>4 &lt; 5</td></tr></table>"
    outer = "<table><tr><td>a<table><tr><td>b</td></tr></table></td></tr></table>"
    assert Tb.tables_of(pipe) == [made] and Tb.tables_of(f"text\n{outer}\n{pipe}\nmore {outer}") == [outer, made, outer]
    for none in ("| a |\n| b |", "a | b\n--- | ---", "<table><tr><td>never ends", "| a |\n|--|\n"):
        assert Tb.tables_of(none) == []


def test_greedy_pairs():
    assert Tb.pair_greedily([(0, 0, 0.6, 0.6), (1, 0, 0.9, 0.9), (0, 1, 0.5, 0.5), (1, 1, 0.4, 0.4)]) == [(1, 0, 0.9, 0.9), (0, 1, 0.5, 0.5)]
    assert Tb.pair_greedily([(0, 0, 0.7, 0.2), (1, 0, 0.7, 0.3)]) == [(1, 0, 0.7, 0.3)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(1, 3), st.integers(1, 2)), max_size=9))
def test_cells_under_row_spans_are_left_out(spec):
    cells = [(r, c, r + h, c + w, f"t{k}") for k, (r, c, h, w) in enumerate(spec)]
    kept = []
    for cell in sorted(cells, key=lambda x: x[:2]):
        if not any(k[1] == cell[1] and k[0] < cell[0] < k[2] for k in kept):
            kept.append(cell)
    assert re.findall("t[0-9]+", Tb.grid_html(cells).replace("<tr>", "").replace("<td", "")) == [k[4] for k in kept]
    assert Tb.grid_html(cells).count("<tr>") == len({k[0] for k in kept})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(1, 25), st.integers(1, 25)), max_size=9))
def test_xy_cut_against_projections(boxes):
    """Each region's projection as pixels: the first longest run of uncovered ones is cut in its middle."""

    def cut(group):
        for axis in (0, 1) if len(group) > 1 else ():
            covered = {p for i in group for p in range(boxes[i][axis], boxes[i][axis] + boxes[i][axis + 2])}
            runs = [(len(list(run)), k) for k, (free, run) in enumerate(groupby(range(min(covered), max(covered)), key=lambda p: p not in covered)) if free]
            if runs and max(runs)[0] >= 8:
                width = max(runs)[0]
                free = [p for p in range(min(covered), max(covered)) if p not in covered]
                start = next(p for p in free if p - 1 in covered and all(q not in covered for q in range(p, p + width)))
                at = (start + start + width) // 2
                return cut([i for i in group if boxes[i][axis] < at]) + cut([i for i in group if boxes[i][axis] >= at])
        return sorted(group, key=lambda i: (boxes[i][1], boxes[i][0]))

    assert xy_cut(boxes) == cut(list(range(len(boxes))))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=200))
def test_rising_pairs(values):
    assert rising_pairs(np.array(values, dtype=np.int64)) == sum(a < b for k, a in enumerate(values) for b in values[k + 1 :])


def test_grids():
    html = Tb.grid_html([(0, 0, 2, 1, "a"), (0, 1, 1, 2, "b"), (1, 1, 2, 2, "c"), (1, 0, 2, 1, "ghost")])
    assert html.count("<td") == 3 and html.count('rowspan="2"') == 1
    assert Tb.coverage_flag("<table><td>", 2, 2) == "invalid_html"
    assert Tb.coverage_flag("<table><tr><td/></tr></table>", 2, 2) == "cell_count_mismatch"
    assert Tb.coverage_flag('<table><tr><td rowspan="2"/><td/></tr><tr><td/></tr></table>', 2, 2) is None


@pytest.mark.parametrize(("rotation", "expected"), [(0, (2.4, 4.8, 24, 12)), (90, (4.8, 765.6, 12, 24)), (180, (585.6, 775.2, 24, 12)), (270, (595.2, 2.4, 12, 24))])
def test_pdf_points(spark, rotation, expected):
    b = G.box(*map(F.lit, (10, 20, 100, 50)))
    p = spark.range(1).select(G.pdf_points(b, F.lit(300), F.lit(rotation), F.lit(612.0), F.lit(792.0)).alias("p")).first().p
    assert tuple(p) == pytest.approx(expected)


@pytest.mark.parametrize("angle", [0, 0.4, -1.7, 3, -5.5])
def test_round_trip_of_frames(spark, angle):
    from math import cos, radians, sin

    a = radians(angle)
    m = F.array(*[F.lit(float(v)) for v in (cos(a), -sin(a), 12, sin(a), cos(a), -7)])
    b = G.box(*map(F.lit, (100, 200, 300, 400)))
    back = G.to_canonical(G.from_canonical(G.corners(b), m), m)
    points = spark.range(1).select(back.alias("p")).first().p
    assert [(p.x, p.y) for p in points] == [pytest.approx(c, abs=1e-6) for c in ((100, 200), (400, 200), (400, 600), (100, 600))]


def test_geometry_errors(spark):
    one = spark.range(1)
    ok = [F.lit(v) for v in (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)]
    error = lambda r, m, w, h: one.select(G.geometry_error(F.lit(r), F.array(*m), F.lit(w).cast("double"), F.lit(h).cast("double"))).first()[0]
    assert error(90, ok, 1, 2) is None and error(45, ok, 1, 2) and error(0, ok[:3], 1, 2) and error(0, ok, None, 2)
    with pytest.raises(Exception, match="singular"):
        one.select(G.to_canonical(G.corners(G.box(*map(F.lit, (1, 2, 3, 4)))), F.array(*[F.lit(0.0)] * 6))).collect()
    with pytest.raises(Exception, match="10,000"):
        one.select(G.element_id(F.lit(1), F.lit(10_000))).collect()
