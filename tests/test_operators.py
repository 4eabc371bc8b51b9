import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import assemble, labels, layout, metrics, qa, recognition, review, serialize

BOX = "struct<x:int,y:int,w:int,h:int>"


def test_text_in_tables(spark):
    rows = [("d", 1, 0, "table", (0, 0, 100, 100)), ("d", 1, 1, "text", (10, 10, 20, 20)), ("d", 1, 2, "text", (90, 90, 100, 10)), ("d", 1, 3, "text", (5, 5, 0, 9)), ("d", 2, 0, "text", (10, 10, 20, 20))]
    boxes = spark.createDataFrame(rows, f"doc_id string, page int, pos int, category string, bbox {BOX}")
    assert {(r.page, r.pos) for r in layout.drop_text_in_tables(boxes).collect()} == {(1, 0), (1, 2), (1, 3), (2, 0)}


def test_words_to_lines(spark):
    rows = [("d", 1, 0, 0, "a", (0, 0, 5, 5), 80.0, [1, 1, 1]), ("d", 1, 0, 1, "b", (6, 0, 5, 5), 80.0, [1, 1, 1]), ("d", 1, 0, 2, "c", (0, 9, 5, 5), 40.0, [1, 1, 2]), ("d", 1, 0, 3, " ", (0, 9, 5, 5), 90.0, [1, 1, 2]), ("d", 1, 0, 4, "x", (0, 9, 5, 5), -1.0, [1, 1, 2])]
    words = spark.createDataFrame(rows, f"doc_id string, page int, box_id int, pos int, text string, bbox {BOX}, confidence double, line_key array<int>")
    lines = layout.words_to_lines(words)
    got = {r.text: r for r in lines.collect()}
    assert set(got) == {"a b", "c"} and got["a b"].confidence == pytest.approx(0.8) and tuple(got["a b"].bbox) == (0, 0, 11, 5)
    element = layout.lines_to_elements(lines).first()
    assert element.text == "a b\nc" and element.rec_score == pytest.approx(0.6)


def test_columns_read_before_rows():
    assert assemble.xy_cut([(60, 30, 40, 20), (0, 0, 40, 20), (60, 0, 40, 20), (0, 30, 40, 20)]) == [1, 3, 2, 0]
    assert assemble.xy_cut([(0, 0, 100, 10), (0, 30, 40, 20), (60, 30, 40, 20)]) == [0, 1, 2]
    gaps = lambda *spans: assemble.widest_gaps(np.zeros(len(spans), dtype=int), *map(np.array, zip(*spans, strict=True)))
    assert gaps((0, 10), (17, 5)) == {} and gaps((0, 10), (18, 5), (31, 5)) == {0: 14}


def elements(spark):
    table = "<table><tbody><tr><td>%s</td></tr></tbody></table>"
    rows = [
        ("d", 10000, "title", 0, "flow", "text", "T", None, None, None, None, None, []),
        ("d", 10001, "table", 1, "flow", "table", None, table % "a", None, None, 10003, None, ["table_continues"]),
        ("d", 20000, "table", 2, "inlined", "table", None, table % "b", None, None, None, 10001, []),
        ("d", 30000, "table", 3, "inlined", "table", None, table % "c", None, None, None, 20000, []),
        ("d", 10003, "caption", 4, "inlined", "text", "Cap", None, None, None, None, None, []),
        ("d", 10004, "text", 5, "flow", None, None, None, None, None, None, None, ["table_continues", "recognize_failed"]),
        ("d", 10005, "picture", 6, "flow", "figure", None, None, None, "p.png", None, None, []),
        ("d", 10006, "page-footer", 7, "aside", "text", "foot", None, None, None, None, None, []),
        ("e", 10000, "caption", 0, "inlined", "text", "x", None, None, None, None, None, []),
    ]
    return spark.createDataFrame(rows, "doc_id string, id long, category string, reading_order int, render string, kind string, text string, html string, latex string, path string, caption_id long, continues_from long, flags array<string>")


def test_markdown(spark):
    got = {r.doc_id: r.markdown for r in serialize.to_markdown(elements(spark)).collect()}
    assert got["e"] == "\n"
    assert got["d"] == (
        "<!-- ann:10000 -->\n# T\n\n<!-- ann:10001 -->\n<table><tbody><tr><td>a</td></tr><tr><td>b</td></tr><tr><td>c</td></tr></tbody></table>\n\nCap\n\n"
        "<!-- ann:10004 recognize_failed -->\n\n<!-- ann:10005 -->\n![](p.png)\n\n<!-- ann-aside -->\n\n<!-- ann:10006 -->\nfoot\n"
    )


def test_coco(spark):
    rows = [("d", 10000, 1, "title", (1, 2, 3, 4), 0, "flow", [(1.0, 2.0), (4.0, 6.0)], 0.5, -0.1, [], "T", None), ("d", 30000, 3, "text", (0, 0, 2, 2), 1, "flow", [], None, None, ["x"], None, None)]
    es = spark.createDataFrame(rows, f"doc_id string, id long, page int, category string, bbox {BOX}, reading_order int, render string, polygon array<struct<x:double,y:double>>, rec_score double, logprob double, flags array<string>, text string, html string")
    docs = spark.createDataFrame([("d", "scan.pdf")], "doc_id string, source string")
    pages = spark.createDataFrame([("d", 3, 10, 20), ("d", 1, 10, 20)], "doc_id string, page int, width_px int, height_px int")
    errors = spark.createDataFrame([("d", 2, "layout", "ValueError: x")], "doc_id string, page int, stage string, message string")
    coco = json.loads(serialize.to_coco(docs, pages, es, errors).first().coco)
    assert [i["id"] for i in coco["images"]] == [1, 3] and coco["images"][0]["file_name"] == "scan.pdf#page=1" and len(coco["categories"]) == 11
    first, second = coco["annotations"]
    assert first["area"] == 12 and first["category_id"] == 11 and first["segmentation"] == [[1.0, 2.0, 4.0, 6.0]] and first["logprob"] == -0.1 and "rec_score" not in first
    assert "segmentation" not in second and "rec_score" not in second and second["flags"] == ["x"] and coco["info"]["page_errors"][0]["page"] == 2


def test_snapshot(spark):
    es = spark.createDataFrame([("d", 1, None, 0.5, None), ("d", 2, "x", None, None)], "doc_id string, id long, text string, rec_score double, logprob double")
    got = json.loads(serialize.to_snapshot(es).first().snapshot)
    assert got["schema"] == 1 and got["elements"] == [{"id": 1, "text": None, "rec_score": 0.5, "logprob": None}, {"id": 2, "text": "x"}]


def test_table_links(spark):
    rows = [("d", 1, 10000, "table", (0, 0, 100, 10), 2), ("d", 2, 20000, "table", (1, 0, 100, 10), 2), ("d", 3, 30000, "table", (50, 0, 100, 10), 2), ("d", 5, 50000, "table", (50, 0, 100, 10), 2), ("d", 6, 60000, "table", (50, 0, 100, 10), None)]
    links = assemble.link_tables(spark.createDataFrame(rows, f"doc_id string, page int, id long, category string, bbox {BOX}, n_cols int"))
    assert [tuple(r) for r in links.collect()] == [("d", 10000, 20000)]


def test_order_and_references(spark):
    es = spark.createDataFrame([("a", 1, 0, None), ("a", 2, 0, 999), ("b", 1, -1, None), ("c", 1, 0, None), ("c", 2, 1, 1)], "doc_id string, id long, reading_order int, caption_id long")
    assert {r.doc_id for r in assemble.order_errors(es).collect()} == {"a", "b"}
    assert [(r.doc_id, r.target) for r in assemble.dangling_references(es, "caption_id").collect()] == [("a", 999)]


def test_gate(spark):
    rows = [("d", 1, 1, 0.9), ("d", 1, 2, 0.5), ("d", 2, 3, None), ("d", 3, 4, 0.75)]
    got = {r.page: r for r in qa.gate(spark.createDataFrame(rows, "doc_id string, page int, id long, signal double")).collect()}
    assert not got[1].passed and got[1].below == [2] and got[1].min_signal == 0.5
    assert got[2].passed and got[2].min_signal is None and got[2].below == [] and got[3].passed


def test_review_round_trip(spark):
    lines = spark.createDataFrame([("d", 3, 0, "một", "mot"), ("d", 3, 1, "hai", "hai"), ("d", 4, 0, "x", "x")], "doc_id string, page int, line_no int, text string, text_ocr string")
    verdicts = spark.createDataFrame([("d", 3, False), ("d", 4, True)], "doc_id string, page int, passed boolean")
    page = review.review_pages(lines, verdicts).first()
    assert page.name == "p0003.md" and page.body == "<!-- page: 3 lines: 2 -->\nmột\nhai\n"
    fixed = page.body.replace("hai", "HAI")
    files = spark.createDataFrame([("d", "p0003.md", fixed), ("d", "p0004.md", "<!-- page: 4 lines: 2 -->\nonly\n"), ("d", "p0005.md", "nothing")], "doc_id string, path string, body string")
    assert {r.path: r.error is None for r in review.parse_pages(files).collect()} == {"p0003.md": True, "p0004.md": False, "p0005.md": False}
    got = {(r.page, r.line_no): r for r in review.apply_corrections(lines, review.corrections(files)).collect()}
    assert got[3, 1].text == "HAI" and got[3, 1].text_ocr == "hai" and got[4, 0].text == "x"
    short = spark.createDataFrame([("d", 3, 0, "one")], "doc_id string, page int, line_no int, text string")
    assert "expected 2" in review.apply_corrections(lines, short).where("page = 3").first().error


def test_page_slices(spark):
    texts = spark.createDataFrame([("a", "x<!-- page: 1 -->one<!-- page: 2 -->two<!-- page: 1 -->again"), ("b", "whole"), ("c", "<!-- page: 3 lines: 2 -->")], "doc_id string, text string")
    assert {(r.doc_id, r.page, r.text) for r in review.page_slices(texts).collect()} == {("a", 1, "one"), ("a", 2, "two"), ("b", None, "whole"), ("c", None, "<!-- page: 3 lines: 2 -->")}


def test_recognition_report(spark):
    schema = "doc_id string, text string"
    predicted = spark.createDataFrame([("a", "x"), ("b", "a b c d<!-- ann-aside -->more words"), ("only_pred", "z")], schema)
    gold = spark.createDataFrame([("a", "y"), ("b", "a b c d"), ("only_gold", "z")], schema)
    pairs = recognition.pair(predicted, gold)
    scores = recognition.score_wer(pairs)
    pooled = recognition.pool_wer(scores).first()
    assert pooled.wer == pytest.approx(0.2) and pooled.n_words == 5
    candidates, counts = recognition.table_candidates(pairs)
    tables = recognition.table_scores(recognition.greedy_pairs(candidates), counts)
    text = recognition.render_report(scores, tables, pairs)
    assert "| **pooled** | 0.2000 | 5 | 0 |" in text and "only_gold: ground truth has no prediction" in text and "only_pred: prediction has no ground-truth record" in text and "| a | - | 0 | 0 | 0 |" in text
    assert recognition.pool_wer(scores.where("false")).first().wer is None


def test_table_scores(spark):
    one = "<table><tr><td>a</td></tr></table>"
    schema = "doc_id string, text string"
    predicted = spark.createDataFrame([("a", one), ("b", "\n".join([one] * 60))], schema)
    gold = spark.createDataFrame([("a", one + "\n" + one), ("b", "\n".join([one] * 60))], schema)
    candidates, counts = recognition.table_candidates(recognition.pair(predicted, gold))
    got = {r.doc_id: r for r in recognition.table_scores(recognition.greedy_pairs(candidates), counts).collect()}
    assert (got["a"].n_matched, got["a"].n_gold, got["a"].n_pred, got["a"].teds, got["a"].table_recall) == (1, 2, 1, 1.0, 0.5)
    assert got["b"].teds is None and got["b"].table_recall is None and "exceeds the 2000-candidate cap" in got["b"].note
    rows = spark.createDataFrame([("x", 1.0, 1.0, 1, 1, 1), ("y", 0.6, 0.6, 3, 4, 3)], "doc_id string, teds double, teds_struct double, n_matched int, n_gold int, n_pred int")
    pool = recognition.pool_tables(rows).first()
    assert pool.teds == pytest.approx(0.7) and (pool.n_matched, pool.n_gold, pool.n_pred) == (4, 5, 4)


def test_word_distance_agrees(spark):
    df = spark.createDataFrame([("a b x d".split(), "a b c d e".split()), ([], ["x"])], "p array<string>, g array<string>")
    assert [r[0] for r in df.select(recognition.word_distance(F.col("p"), F.col("g"))).collect()] == [2, 1]


def test_labels(spark):
    lines = spark.createDataFrame([("d", 1, 0, "Hello"), ("d", 1, 1, "World"), ("e", 1, 0, "aaaaaaa"), ("f", 1, 0, "x")], "doc_id string, page int, line_no int, text string")
    gold = spark.createDataFrame([("d", 1, "Hello\nWorld"), ("e", 1, "zzzzzzz totally different")], "doc_id string, page int, text string")
    out = labels.align_lines(lines, gold)
    got = {(r.doc_id, r.line_no): r for r in out.collect()}
    assert got["d", 1].label == "World" and got["e", 0].label is None and "similarity" in got["e", 0].reason and got["f", 0].reason == "empty ocr or ground truth"
    assert {r.doc_id: (r.written, r.rejected) for r in labels.report(out).collect()} == {"d": (2, 0), "e": (0, 1), "f": (0, 1)}
    with pytest.raises(ValueError, match="50"):
        labels.training_list(spark.createDataFrame([("s",)], "stem string"))


def test_labels_of_awkward_pages(spark):
    """Lines out of order or null, pages without lines, a page with two gold texts, keys of another type or null; one exchange takes all to their pages."""
    lines = spark.createDataFrame([("d", 1, 1, "World"), ("d", 1, 0, "Hello"), ("d", 2, 0, None), ("d", 2, 1, "rain"), (None, 1, 0, "x"), ("t", 1, 0, "snow")], "doc_id string, page int, line_no int, text string")
    gold = spark.createDataFrame([("d", 1, "Hello\nWorld"), ("d", 2, "rain"), (None, 1, "x"), ("d", 9, "no lines"), ("t", 1, "snow"), ("t", 1, None)], "doc_id string, page long, text string")
    out = labels.align_lines(lines, gold)
    assert out.schema["page"].dataType.simpleString() == "int"
    empty = "empty ocr or ground truth"
    assert sorted(map(tuple, out.select("doc_id", "page", "line_no", "label", "reason").collect()), key=str) == sorted([
        ("d", 1, 0, "Hello", None), ("d", 1, 1, "World", None), ("d", 2, 0, None, "empty gt span"), ("d", 2, 1, "rain", None), (None, 1, 0, None, empty), ("t", 1, 0, "snow", None), ("t", 1, 0, None, empty),
    ], key=str)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_metrics(spark):
    b = f"doc_id string, page int, pos int, category string, bbox {BOX}"
    gold = spark.createDataFrame([("d", 1, 0, "text", (0, 0, 10, 10)), ("d", 1, 1, "table", (50, 50, 10, 10))], b)
    predicted = spark.createDataFrame([("d", 1, 0, "title", (0, 0, 10, 9))], b)
    r = metrics.detection_scores(metrics.detections(predicted, gold), predicted, gold).first()
    assert (r.precision, r.recall, r.f1, r.type_accuracy) == (1.0, 0.5, pytest.approx(2 / 3), 0.0)
    order = spark.createDataFrame([("d", 0, 0), ("d", 1, 2), ("d", 2, 1), ("e", 0, 0)], "doc_id string, reading_order int, gold_order int")
    tau = {r.doc_id: r.tau for r in metrics.order_tau(order).collect()}
    assert tau["d"] == pytest.approx(1 / 3) and tau["e"] is None
    assert metrics.calibration(spark.createDataFrame([(1.0, 1), (0.95, 0)], "confidence double, correct int")).first().bin == 9


def test_boxes_are_matched_greedily(spark):
    """A box whose best partner is taken gets the next one."""
    rows = lambda xs: spark.createDataFrame([("d", 1, i, "text", (x, 0, 100, 10)) for i, x in enumerate(xs)], f"doc_id string, page int, pos int, category string, bbox {BOX}")
    found = metrics.detections(rows([0, 10]), rows([4, 30]))  # box 1 is nearest to 4, which box 0 has
    assert sorted((r.p, r.g) for r in found.collect()) == [(0, 0), (1, 1)]
