import random
from collections import Counter

import corpus_pipeline
from llm_fixtures import WORD, documents, empty, frame, prose
from test_llm_lines import expected
from test_llm_mixing import goals


def corpus():
    rng = random.Random(11)
    rows = []
    for k in range(120):
        lang = ["en", "de", "fr"][k % 3]
        text = "\n".join(" ".join(f"{w}{rng.randrange(90)}" if rng.random() < 0.3 else w for w in prose(rng, lang, 30).split()) for _ in range(6))
        rows.append((k, text, lang, "abc"[k % 3], len(text), *["x"] * 9))
    shared = rows[0][1].split("\n")
    rows.append((500, "\n".join([*shared[:3], "an ending of its own"]), "en", "a", 1, *["x"] * 9))  # a repeated run
    words = rows[4][1].replace("\n", " \n ").split(" ")
    rows.append((501, " ".join(words).replace("\n", " "), "en", "b", 1, *["x"] * 9))  # the words of document 4 on one line
    rows += [(502, None, None, "a", None, *["x"] * 9), (503, "12 %% 34", "en", "c", 8, *["x"] * 9)]
    return rows


def test_stages(spark, tmp_path):
    rows = corpus()
    docs, columns = frame(spark, rows), frame(spark, rows).columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != "pack":
            assert docs.columns == columns
    texts = {r[0]: r[1] for r in rows}
    assert {r["doc_id"] for r in kept["language_id"]} == set(texts) - {502, 503}
    wanted = {r[0]: r[2] for r in expected([(i, t) for i, t in texts.items() if i < 502])}
    for r in kept["line_dedup"]:
        lines = len([x for x in r["text"].split("\n") if WORD.search(x)])
        before = len([x for x in texts[r["doc_id"]].split("\n") if WORD.search(x)])
        assert before - lines == wanted[r["doc_id"]] and r["n_chars"] == len(r["text"])
    assert wanted[500] == 3
    assert {r["doc_id"] for r in kept["near_dedup"]} == set(texts) - {501, 502, 503}
    sizes, taken = Counter(), Counter()
    for r in kept["near_dedup"]:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    for r in kept["mix_sources"]:
        taken[r["source"]] += len(WORD.findall(r["text"]))
    longest = max(len(WORD.findall(r["text"])) for r in kept["near_dedup"])
    assert all(abs(taken[s] - t) <= longest for s, t in goals(sizes).items())
    assert sum(r["length"] for r in kept["pack"] if r["start"] == 0) > 0
    tokens = Counter()
    for r in kept["pack"]:
        tokens[r["doc_id"]] += r["length"]
    times = Counter(r["doc_id"] for r in kept["mix_sources"])
    full = {r["doc_id"]: r["doc_tokens"] for r in kept["pack"]}
    assert tokens == Counter({d: n * full[d] for d, n in times.items()})


def test_odd_and_empty_documents(spark, tmp_path):
    for rows in (frame(spark, documents(20)), empty(spark)):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{rows.count()}")
            stage(spark, docs, "").write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path) if name != "pack" else spark.read.parquet(path)
            docs.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and "sequence_id" in out.columns
