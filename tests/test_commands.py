import json

import pytest
from pyspark.sql import functions as F

from quire.__main__ import main
from quire.operators import assemble, labels, recognition, review, serialize
from quire.sources import files, writers


def put(folder, **texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (folder / name.replace("__", ".")).write_text(text, encoding="utf-8")


def test_evaluate(spark, tmp_path, capsys):
    put(tmp_path / "pred", a__md="one two three\n\n| h |\n|---|\n| 1 |\n", b__md="lonely")
    put(tmp_path / "gold", a__md="one two four\n<table><tr><th>h</th></tr><tr><td>1</td></tr></table>", a__json='{"doc_id": "a", "text_file": "a.md"}', c__md="x", c__json='{"doc_id": "c", "text_file": "c.md"}')
    run = lambda *more: main(["evaluate", "recognition", "--pred", str(tmp_path / "pred"), "--gt", str(tmp_path / "gold"), "--results", str(tmp_path / "out"), *more])
    assert run("--label", "mine") == 0
    report = (tmp_path / "out/mine/gold.md").read_text()
    assert "- b: " in report and "- c: " in report and "| a |" in report and "1.0000 | 1 | 1 | 1 |" in report
    assert run("--doc", "a") == 0 and "- b: " not in (tmp_path / "out/pred/gold.md").read_text()
    assert run("--doc", "b") == 1 and main(["evaluate", "layout", "--pred", str(tmp_path), "--gt", str(tmp_path)]) == 1
    assert main(["evaluate", "recognition", "--pred", str(tmp_path / "none"), "--gt", str(tmp_path)]) == 1
    assert "nothing was scored" in capsys.readouterr().err


def test_convert(spark, tmp_path):
    put(tmp_path / "loose", a__txt="text a", b__md="text b")
    put(tmp_path / "scans", a__pdf="%")
    put(tmp_path / "out", b__json="{}")
    assert main(["convert", str(tmp_path / "loose"), "--out", str(tmp_path / "out"), "--source-dir", str(tmp_path / "scans")]) == 0
    assert json.loads((tmp_path / "out/a.json").read_text()) == {"doc_id": "a", "file": "a.pdf", "text_file": "a.md"} and (tmp_path / "out/a.md").read_text() == "text a"
    assert (tmp_path / "out/b.json").read_text() == "{}" and not (tmp_path / "out/b.md").exists()
    assert main(["convert", str(tmp_path / "loose")]) == 1  # a .txt doesn't become a record where it is


ELEMENTS = "doc_id string, id long, page int, category string, bbox struct<x:int,y:int,w:int,h:int>, polygon array<struct<x:double,y:double>>, reading_order int, render string, kind string, text string, lines array<struct<text:string,text_ocr:string,polygon:array<array<double>>,confidence:double>>, html string, n_rows int, n_cols int, latex string, path string, caption_id long, continues_from long, flags array<string>, rec_score double"


@pytest.fixture
def document(spark):
    line = lambda t: (t, t, [[0.0, 1.0]], 0.5)
    rows = [
        ("d", 10000, 1, "title", (0, 0, 9, 9), None, 0, "flow", "text", "Ä head", [line("Ä head")], None, None, None, None, None, None, None, [], 0.9),
        ("d", 10001, 1, "text", (0, 10, 9, 9), [(0.0, 1.0), (2.0, 3.0)], 1, "flow", "text", "l1\nl2", [line("l1"), line("l2")], None, None, None, None, None, None, None, [], 0.5),
        ("d", 20000, 2, "table", (0, 0, 9, 9), None, 2, "flow", "table", None, None, "<table><tbody><tr><td>1</td></tr></tbody></table>", 1, 1, None, None, None, None, ["table_continues"], None),
        ("d", 20001, 2, "picture", (0, 0, 9, 9), None, 3, "flow", None, None, None, None, None, None, None, None, None, None, ["recognize_failed"], None),
    ]
    elements = spark.createDataFrame(rows, ELEMENTS)
    documents = spark.createDataFrame([("d", "scan.pdf", "ab" * 32, "v1")], "doc_id string, source string, doc_sha256 string, pipeline_version string")
    pages = spark.createDataFrame([("d", p, 100, 200, 300, 0, 0.0, [1.0, 0.0, 0.0, 0.0, 1.0, 0.0], None, None) for p in (1, 2)], "doc_id string, page int, width_px int, height_px int, dpi int, rotation_applied int, deskew_angle double, deskew_matrix array<double>, pdf_width_pt double, pdf_height_pt double")
    errors = spark.createDataFrame([("d", 3, "layout", 'E: "x"')], "doc_id string, page int, stage string, message string")
    return documents, pages, elements, errors


def test_snapshots_round_trip(spark, tmp_path, document):
    documents, pages, elements, errors = document
    assert writers.write_documents(*document, str(tmp_path), ("markdown", "coco")) == ["d/d.md", "d/d.coco.json", "d/d.document.json"]
    held = json.loads((tmp_path / "d/d.document.json").read_text())
    assert list(held) == ["schema", "source", "doc_sha256", "pipeline_version", "pages", "elements", "errors"] and held["pages"][0]["pdf_width_pt"] is None
    first, second, table, failed = held["elements"]
    assert first["content"] == {"kind": "text", "text": "Ä head", "lines": [{"text": "Ä head", "text_ocr": "Ä head", "polygon": [[0.0, 1.0]], "confidence": 0.5}]}
    assert second["polygon"] == [[0.0, 1.0], [2.0, 3.0]] and first["rec_score"] == 0.9 and first["logprob"] is None and "rec_score" not in table
    assert table["content"] == {"kind": "table", "html": "<table><tbody><tr><td>1</td></tr></tbody></table>", "n_rows": 1, "n_cols": 1, "cell_boxes": []} and failed["content"] is None
    assert held["errors"] == [{"page": 3, "stage": "layout", "message": 'E: "x"'}] and sorted(p.name for p in (tmp_path / "d").iterdir()) == ["d.coco.json", "d.document.json", "d.md"]
    back = files.read_snapshots(spark, f"{tmp_path}/d/d.document.json")
    rows = serialize.decoded_elements(back).select(*elements.columns).orderBy("id").collect()
    want = elements.orderBy("id").collect()
    assert [(r.id, r.bbox, r.text, r.lines, r.html, r.flags, r.rec_score, r.kind) for r in rows] == [(r.id, r.bbox, r.text, r.lines, r.html, r.flags, r.rec_score, r.kind) for r in want]
    with pytest.raises(files.SourceError):
        files.read_snapshots(spark, f"{tmp_path}/none/none.document.json")
    with pytest.raises(writers.WriteError):
        writers.write_documents(*document, str(tmp_path / "other"), ("pdf",))
    put(tmp_path / "old", x__json='{"schema": 2}')
    with pytest.raises(Exception, match="unsupported schema 2"):
        files.read_snapshots(spark, f"{tmp_path}/old").collect()


def test_review_round_trip(spark, tmp_path, document):
    documents, pages, elements, errors = document
    writers.write_documents(*document, str(tmp_path / "out"))
    lines = review.page_lines(elements.where("kind = 'text'").select("doc_id", "page", "reading_order", "id", F.posexplode("lines").alias("pos", "l")).select("doc_id", "page", "reading_order", "pos", "l.text"))
    verdicts = spark.createDataFrame([("d", 1, False), ("d", 2, True)], "doc_id string, page int, passed boolean")
    sent, image = review.review_pages(lines, verdicts), spark.createDataFrame([("d", 1, b"pixels")], "doc_id string, page int, content binary")
    assert writers.write_review(sent, image, str(tmp_path / "review")) == ["d/p0001.md", "d/p0001.webp"]
    with pytest.raises(writers.WriteError):
        writers.write_review(sent, image.where("page = 2"), str(tmp_path / "review"))
    page = tmp_path / "review/d/p0001.md"
    page.write_text(page.read_text().replace("l2", "line two"))
    put(tmp_path, c__json=json.dumps({"output_dir": str(tmp_path / "out"), "review_dir": str(tmp_path / "review")}))
    run = lambda: main(["apply-review", "d", "--config", str(tmp_path / "c.json")])
    good = page.read_text()
    page.write_text(good + "one more\n")
    assert run() == 2 and page.exists()
    page.write_text(good)
    assert run() == 0 and not (tmp_path / "review/d").exists()
    held = json.loads((tmp_path / "out/d/d.document.json").read_text())["elements"][1]["content"]
    assert held["text"] == "l1\nline two" and held["lines"][1]["text"] == "line two" and held["lines"][1]["text_ocr"] == "l2"
    assert "line two" in (tmp_path / "out/d/d.md").read_text()
    assert run() == 2  # nothing to apply


def test_labels_of_artifacts(spark, tmp_path, document):
    _, pages, elements, _ = document
    geometry = pages.where("page = 1").drop("doc_id").first().asDict()
    held = [json.loads(r.j) for r in elements.where("page = 1").withColumn("category", F.lit("text")).select(serialize.element_json(elements).alias("j")).collect()]
    put(tmp_path / "art/abcabcabcabc/v1/pages", p1__json=json.dumps({"schema": 1, "geometry": geometry, "elements": [e | {"category": "text"} for e in held]}))
    put(tmp_path / "gold", g__md="<!-- page: 1 -->\nÄ head\nl1\nzz", g__json='{"doc_id": "g", "text_file": "g.md"}')
    put(tmp_path, c__json=json.dumps({"artifacts_dir": str(tmp_path / "art"), "ground_truth_dir": str(tmp_path / "gold")}))
    run = lambda sha: main(["align", "--sha", sha, "--version", "v1", "--stem", "g", "--data-dir", str(tmp_path / "train"), "--config", str(tmp_path / "c.json")])
    assert run("abcabcabcabcdef") == 0 and run("ffffffffffffffff") == 2
    assert (tmp_path / "train/abcabcabcabc/p0001_l0000.gt.txt").read_text() == "Ä head" and (tmp_path / "train/rejected.log").read_text().startswith("abcabcabcabc/p0001_l0002: similarity 0.")
    assert main(["training-list", "--data-dir", str(tmp_path / "train")]) == 2  # too few
    put(tmp_path / "art/abcabcabcabc/v2/pages", p1__json=json.dumps({"schema": 1, "geometry": geometry | {"rotation_applied": 45}, "elements": []}))
    with pytest.raises(Exception, match="quarter turn"):
        files.read_artifacts(spark, str(tmp_path / "art"), "abcabcabcabc", "v2").collect()


def test_parts_of_the_label_run(spark):
    aligned = spark.createDataFrame([("d", 1, 0, "a"), ("d", 1, 1, None)], "doc_id string, page int, line_no int, label string")
    crops = spark.createDataFrame([("d", "/x/p0001_l0000.png"), ("d", "/x/other.png")], "doc_id string, path string")
    assert [r.label for r in labels.with_crops(aligned, crops).collect()] == ["a"]
    gold = spark.createDataFrame([("e", 1)], "doc_id string, page int")
    assert [tuple(r) for r in labels.skipped_documents(aligned, gold).collect()] == [("d", 1, "no ground truth")]


def test_unparsable_tables_are_errors(spark):
    rows = spark.createDataFrame([("d", 0, 1, 3, 0)], "doc_id string, p int, g int, n_predicted int, n_gold int")
    with pytest.raises(Exception, match="d: gold table 1 can't be parsed"):
        recognition.require_parsed(rows).collect()


def test_content_in_the_canonical_frame(spark):
    box = "struct<x:int,y:int,w:int,h:int>"
    e = spark.createDataFrame([([1.0, 0.0, 10.0, 0.0, 1.0, 5.0], [("t", [(10.0, 5.0)])], [(12, 6, 3, 4)])], f"deskew_matrix array<double>, lines array<struct<text:string,polygon:array<struct<x:double,y:double>>>>, cell_boxes array<{box}>")
    r = assemble.content_to_canonical(e).first()
    assert [tuple(p) for p in r.lines[0].polygon] == [(0.0, 0.0)] and tuple(r.cell_boxes[0]) == (2, 1, 3, 4)


def test_newest_file_of_the_first_pattern(spark):
    found = spark.createDataFrame([("/m/a.best", 1), ("/m/b.best", 2), ("/m/c.last", 9)], "path string, modificationTime int")
    assert files.newest_file(found, r"\.best$", r"\.last$").first().path == "/m/b.best" and files.newest_file(found, "x", r"\.last$").first().path == "/m/c.last" and files.newest_file(found, "x").count() == 0


def test_files_that_exist_stay(spark, tmp_path):
    rows = spark.createDataFrame([("x/a.txt", "new")], "path string, content string")
    put(tmp_path / "x", a__txt="old")
    assert writers.write_files(rows, str(tmp_path), overwrite=False) == [] and (tmp_path / "x/a.txt").read_text() == "old"
    assert writers.write_files(rows, str(tmp_path)) == ["x/a.txt"] and (tmp_path / "x/a.txt").read_text() == "new"
