"""The pipeline's stages on a small corpus, one after another."""

import random

import corpus_pipeline
from scriptorium.tables import keep


def test_stages(spark, tmp_path):
    r = random.Random(1)
    text = lambda n: " ".join(f"u{r.randrange(10**6)}" for _ in range(n))
    item, base = text(30), text(100)
    rows = [(i, text(80), "en", f"s{i % 3}", 0) for i in range(40)]
    rows += [(100, base, "en", "s0", 0), (101, base + " more", "en", "s1", 0), (102, base, "en", "s1", 0), (103, text(20) + " " + item, "en", "s2", 0), (104, "short", "en", "s0", 0), (105, "again and again " * 50, "en", "s0", 0), (106, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left, seen = docs, []
    for name, stage in corpus_pipeline.STAGES:
        left, _ = keep(stage(spark, left, str(tmp_path)), name)
        seen.append(left)
    ids = lambda df: {x.doc_id for x in df.select("doc_id").collect()}
    clean = set(range(40))
    assert ids(seen[0]) == clean | {100, 101, 102, 103} and ids(seen[1]) == clean | {100, 103} and ids(seen[2]) == clean | {100}
    assert all(x.columns == docs.columns for x in seen[:4])
    sizes = {x.doc_id: len(x.text.split()) for x in seen[2].collect()}
    total = sum(len(x.text.split()) for x in seen[3].collect())
    assert abs(total - 1.5 * sum(sizes.values())) <= 3 and ids(seen[3]) <= ids(seen[2])
    assert seen[4].count() == seen[3].count() and set(corpus_pipeline.run(spark, str(tmp_path)).toPandas().ids_crc32) == set(seen[4].toPandas().ids_crc32)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_by_row(spark):
    """Null and repeated keys: rows are told apart by key and text, and other columns follow their row."""
    r = random.Random(2)
    text = lambda n: " ".join(f"u{r.randrange(10**6)}" for _ in range(n))
    a, b, c, d = (text(60) for _ in range(4))
    rows = [(None, a, "x"), (None, a, "y"), (None, b, "x"), (None, c, "x"), (None, c + " more", "x"), (None, "", "x"), (None, "", "x"), (None, None, "x"), (7, c, "z"), (7, d, "z"), (8, d + " end", "z"), (7, d, "w"), (9, None, "z")]
    docs = spark.createDataFrame([(k, t, "en", s, 0) for k, t, s in rows], "doc_id long, text string, lang string, source string, __c long")
    got = sorted(((x.doc_id, x.text, x.source) for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(None, a, "x"), (None, b, "x"), (7, c, "z"), (7, d, "w"), (None, "", "x"), (None, "", "x"), (None, None, "x"), (9, None, "z")], key=str)
