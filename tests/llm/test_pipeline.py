import random

import pytest

import corpus_pipeline
from stratalake.llm import tiling


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    rng = random.Random(1)
    vocabulary = [f"{a}{b}" for a in ("th", "er", "on", "an", "re") for b in range(300)]

    def line(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    rows = [[i, "\n".join(line(rng.randint(12, 30)) for _ in range(rng.randint(2, 5))), "en", f"s{i % 3}", 0] for i in range(150)]
    marks = [(i, 1, 0) for i in range(150)]
    for i in range(0, 150, 5):
        w = rows[i][1].split(" ")
        for _ in range(6):
            w[rng.randrange(len(w))] = rng.choice(["idiot", "moron", "scum"])
        rows[i][1] = " ".join(w)
        marks[i] = (i, 1, 1)
    items = [(i, line(30)) for i in range(5)]
    rows.append([200, line(20) + "\n" + items[0][1] + "\n" + line(20), "en", "s0", 0])
    rows.append([201, rows[7][1], "en", "s0", 0])
    shared = line(60)
    for i in (202, 203):
        rows.append([i, line(25) + "\n" + shared + "\n" + line(25), "en", "s1", 0])
    near = line(400).split(" ")
    rows.append([204, " ".join(near), "en", "s1", 0])
    near[100] = near[300] = "changed"
    rows.append([205, " ".join(near), "en", "s1", 0])
    rows += [[206, None, None, None, None], [207, "", "en", "s1", 0]]
    for r in rows:
        r[4] = None if r[1] is None else len(r[1])
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, {r[0]: r[1] for r in rows}, shared


def test_every_stage_decides(spark, small):
    folder, texts, shared = small
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    toxic = set(range(0, 150, 5))
    clean = set(range(150)) - toxic
    assert len(toxic & got.keys()) <= 2 and len(clean - got.keys()) <= 3
    # a contaminated document, an exact copy and a near copy go
    assert not {200, 201, 205} & got.keys() and 204 in got
    assert got[202]["text"] == texts[202] and shared not in got[203]["text"]
    assert got[203]["n_chars"] == len(got[203]["text"]) and got[203]["n_tokens"] > 0
    assert got[206]["text"] is None and got[207]["text"] == ""


def test_stages_keep_the_columns(spark, small):
    folder = small[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, folder)
        assert made.columns == docs.columns and [f.dataType for f in made.schema] == [f.dataType for f in docs.schema]
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_decontamination_matches_plain_coverage(spark, small):
    folder = small[0]
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [r["text"] for r in bench.collect()]
    bad = {r["doc_id"] for r in tiling.judge(docs, bench).where("contaminated").collect()}
    assert bad == {r["doc_id"] for r in docs.collect() if any(i in (r["text"] or "") for i in items)}
