"""The registered queries, their SQL and the pipeline on the smallest tables."""

import collections
import re
import zlib
from itertools import pairwise
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm.queries import oracle_sql, queries
from tests.llm.test_operators import WORD, lower, slow_quality, slow_windows

DIR = Path("/root/testdata/sf0.001")
TABLES = "documents pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DIR.is_dir(), reason="needs the test tables")


def shown(rows):
    return sorted(tuple(f"{x:.6g}" if isinstance(x, float) else str(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_against_sql(spark, name):
    df = queries()[name](spark, str(DIR))
    columns = sorted(df.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    found = con.execute(oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    assert shown(df.select(*columns).collect()) == shown([tuple(r[names.index(c)] for c in columns) for r in found.fetchall()])


def slow_near_copies(rows):
    """The rows (doc_id, text) that stay: one of each group of texts whose sets of five-word shingles are alike by 0.8 or more; rows without a doc_id stay."""
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    group = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x == sets[j] or len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    signed = lambda t: (h := xxhash.xxh64_intdigest(t or "", 42)) - (h >> 63 << 64)
    best = {}
    for g, (i, text) in zip(group, rows, strict=True):
        if i is not None:
            best[g] = min(best.get(g, (i, signed(text), text)), (i, signed(text), text))
    return [r for r in rows if r[0] is None] + [(i, text) for i, _, text in best.values()]


def slow_pieces(rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        yield from ((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())) for k, (a, b) in enumerate(pairwise(cuts)))


def test_pipeline(spark, tmp_path):
    """Every stage on what the one before kept, with near copies, null and repeated ids, against code of its own."""
    import corpus_pipeline as P

    from quire.llm.common import materialize

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    given = {r.doc_id: (r.text, r.lang, r.source) for r in docs.collect()}
    item = spark.read.parquet(f"{DIR}/benchmark.parquet").first().text
    long = sorted(i for i, (text, _, _) in given.items() if 200 < len(WORD.findall(text or "")) < 400)[:6]
    edited = lambda i, n: " ".join(w if k % n else "edited" for k, w in enumerate(WORD.findall(given[i][0]), 1))
    plain = [" ".join(f"{x}{k}" for k in range(120)) for x in ("own", "other", "third")]
    more = [(5000 + i, edited(i, 120)) for i in long] + [(6000 + i, edited(i, 9)) for i in long] + [(5000, plain[0]), (5000, plain[1]), (5000, plain[1]), (None, plain[0]), (None, plain[2]), (5001, plain[2] + " <|endoftext|> " + item), (5002, plain[2] + " token = abcdefabcdefabcdef")]
    extra = spark.createDataFrame([(i, x, "en", "added", len(x)) for i, x in more], docs.schema)
    docs.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{DIR}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept, rows = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in P.STAGES[:-1]:
        kept = materialize(stage(spark, kept, str(tmp_path)))
        assert kept.columns == docs.columns
        rows.append([(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()])
    same = lambda x, y: collections.Counter(x) == collections.Counter(y)

    every = [(i, *x) for i, x in given.items()] + [(i, x, "en", "added") for i, x in more]
    assert same(rows[0], [(i, text) for (i, text, *_), good in zip(every, slow_quality([x[1:] for x in every]), strict=True) if good])
    assert len(rows[0]) > 100 and {5000, 5001, 5002, None} <= {i for i, _ in rows[0]}

    assert same(rows[1], slow_near_copies(rows[0])) and len(rows[1]) < len(rows[0])
    assert not {5000 + i for i in long} & {i for i, _ in rows[1]}

    items = [r.text for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    leaks = lambda text: any(slow_windows(text, x)[0] >= 0.8 for x in items if x)
    clean = [r for r in rows[1] if not leaks(r[1])]
    assert same(rows[2], clean) and 5001 not in {i for i, _ in clean}

    base = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}|AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}""")
    assert len(rows[3]) == len(rows[2]) and not [t for _, t in rows[3] if base.search(t)]
    cut = lambda text: [x for x in re.split(re.escape("[SECRET]"), text)]
    was = collections.defaultdict(list)
    for i, text in rows[2]:
        was[i].append(text)
    for i, text in rows[3]:  # what isn't replaced is as it was
        assert any(re.fullmatch(".+?".join(map(re.escape, cut(text))), x, re.S) for x in was[i])

    packed = P.run(spark, str(tmp_path)).collect()
    assert same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed], slow_pieces(rows[3]))
    by = collections.defaultdict(list)
    for r in packed:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(places)) and sum(places[-1]) <= 2048


def test_result_of_awkward_documents(spark, tmp_path):
    """A table of nulls, blanks and repeats goes through the whole pipeline."""
    import corpus_pipeline as P

    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, None, None, None, None), (None, text + " x", None, "b", 2), (3, "", "en", "a", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in P.run(spark, str(tmp_path)).collect()} == {1, None}


def test_pipeline_bounds_batches_by_bytes(spark):
    """Every stage bounds what a task holds of texts, for the executors too that run its result later; a bound of the session's own stays."""
    import corpus_pipeline as P
    from quire.llm.common import BATCHES

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "size": [b.nbytes]})

    docs, before = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 500) AS text", "'en' AS lang", "'a' AS source"), {k: spark.conf.get(k, None) for k in BATCHES}
    stages = [P.bounded(lambda spark, docs, sf_dir: docs), P.keep_good, *[stage for _, stage in P.STAGES]]
    try:
        for stage in stages:
            for key in BATCHES:
                spark.conf.unset(key)
            stage(spark, docs.limit(5), str(DIR))
            assert all(spark.conf.get(k, None) == v for k, v in BATCHES.items()), stage
        found = docs.mapInArrow(sizes, "rows long, size long").collect()
        assert sum(r.rows for r in found) == 4000 and max(r.size for r in found) < 3 << 20
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "65536")
        P.keep_good(spark, docs.limit(5), str(DIR))
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "65536"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_quality_stage_sends_a_text_once(spark):
    """keep_good's texts go to Python once, under any case of their name, and come back unchanged; other types of text go along as bytes."""
    from quire.llm import quality_rules

    text = " ".join(f"wörd{i}" for i in range(60))
    df = spark.createDataFrame([(1, text, "en", "a"), (2, None, "en", "a"), (3, text + "\n\x00é", None, None)], "doc_id long, text string, lang string, source string")
    names = {m: m for m in quality_rules.METRICS}
    for docs, sent in ((df, 1), (df.withColumnRenamed("text", "TEXT"), 1), (df.withColumn("text", F.encode("text", "UTF-8")), 2)):
        rows = quality_rules.measured(docs, names, docs.columns)
        want = [(*r, *quality_rules.measure(r[1] if r[1] is None else bytes(r[1]) if sent == 2 else r[1].encode())) for r in map(tuple, docs.collect())]
        assert sorted(map(tuple, rows.collect())) == sorted(want)
        plan = rows._jdf.queryExecution().optimizedPlan()
        while plan.nodeName() != "MapInArrow":
            plan = plan.children().head()
        fed = plan.children().head().output()
        assert sum(fed.apply(k).dataType().simpleString() == "binary" or fed.apply(k).name() == "c1" for k in range(fed.size())) == sent
        assert [r[0] for r in quality_rules.keep_good(docs).select("doc_id").orderBy("doc_id").collect()] == [1, 3]
