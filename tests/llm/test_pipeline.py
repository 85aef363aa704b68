"""The pipeline over a small table, stage by stage, and the registered queries of the subpackage."""

import random

import corpus_pipeline
from test_near_dedup import brute_force

import __spark_entry__
from tickloom.llm import queries

NAMES = ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]


def _write(spark, folder):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randrange(2, 9))) for _ in range(3000)]
    text = lambda n: [words[min(int(rnd.paretovariate(0.5)), 2999)] for _ in range(n)]
    items = [(i, " ".join(text(30))) for i in range(10)]
    rows, labels = [], []
    for i in range(500):
        w = text(rnd.randrange(30, 120))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(5):
                w.insert(rnd.randrange(len(w)), rnd.choice(["badaa", "badbb", "badcc"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    clean = [(i, t) for i, t in rows if i % 4]
    for k in range(40):
        i, t = clean[k]
        rows.append((1000 + i, t))  # exact copies
        rows.append((2000 + i, t + " end"))  # near copies
    for k in range(20):
        w = text(80)
        w[40:40] = items[k % 10][1].split()
        rows.append((3000 + k, " ".join(w)))
    rows += [(4000, "the password=" + "4f0c9a2be7d1" * 2 + " of " + " ".join(text(30))), (4001, None), (4002, ""), (None, " ".join(text(30)))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                          "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages(spark, tmp_path):
    folder = str(tmp_path / "data")
    _write(spark, folder)
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, function in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        function(spark, docs, folder).write.parquet(out)
        before, docs = docs, spark.read.parquet(out)
        if name != NAMES[-1]:
            assert docs.columns == columns and docs.dtypes == before.dtypes
        seen[name] = (before, docs)
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}

    before, after = seen["toxicity"]
    gone = ids(before) - ids(after)
    assert len(gone) > 110 and sum(i is not None and i < 500 and i % 4 == 0 for i in gone) / len(gone) > 0.97

    before, after = seen["near_duplicates"]
    rows = [(r[0], r[1]) for r in before.select("doc_id", "text").collect() if r[0] is not None]
    expected = {i for i, _, c in brute_force(rows) if i == c}
    assert ids(after) == expected | {None} and after.count() == len(expected) + 1

    before, after = seen["decontamination"]
    assert ids(before) - ids(after) == {3000 + k for k in range(20)} & ids(before)

    before, after = seen["secrets"]
    assert ids(before) == ids(after)
    row = after.where("doc_id = 4000").first()
    assert "4f0c9a2be7d1" not in row["text"] and row["n_chars"] == len(row["text"])
    same = after.where("doc_id <> 4000").select("doc_id", "text").collect()
    assert set(same) == set(before.where("doc_id <> 4000").select("doc_id", "text").collect())

    before, after = seen["packing"]
    assert ids(after) == ids(before)
    assert after.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 4096").count() == 0


def test_whole_run_gives_the_last_stage(spark, tmp_path):
    folder = str(tmp_path / "data")
    _write(spark, folder)
    found = corpus_pipeline.run(spark, folder)
    assert found.columns[:4] == ["doc_id", "piece", "start", "length"] and found.count() > 300


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
