import random

import corpus_pipeline


def sentence(rng, words, vocabulary):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(words))


def test_stages_work_on_all_that_the_one_before_kept(spark, tmp_path):
    rng = random.Random(1)
    docs = [(i, sentence(rng, 80, 5000) + ".", "en", "s", 1) for i in range(120)]
    docs += [(200 + i, "JUNK!! " * 30 + sentence(rng, 20, 50).upper() + "!!", "en", "s", 1) for i in range(60)]
    docs += [(300, docs[0][1], "en", "s", 1), (301, docs[1][1].replace(" w", " e", 1), "en", "s", 1)]
    item = sentence(rng, 30, 5000)
    docs += [(310, sentence(rng, 40, 5000) + " " + item + " " + sentence(rng, 40, 5000), "en", "s", 1)]
    docs += [(320, sentence(rng, 40, 5000) + " write to some.one@mail.org now " + sentence(rng, 30, 5000), "en", "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(d[0], int(d[0] < 200 or d[0] >= 300), 0) for d in docs]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/{name}"
        stage(spark, frame, str(tmp_path)).write.parquet(path)
        frame = spark.read.parquet(path)
        kept[name] = {r.doc_id for r in frame.select("doc_id").collect()}
        if name != "packing":
            assert sorted(frame.columns) == sorted(schema.replace(",", "").split()[::2])
        if name == "private":
            texts = {r.doc_id: (r.text, r.n_chars) for r in frame.collect()}
            assert "mail.org" not in texts[320][0] and texts[5] == (docs[5][1], len(docs[5][1]))
    clean = set(range(120)) | {310, 320}
    assert kept["quality"] == clean | {300, 301}
    assert kept["near_dedup"] == clean
    assert kept["decontaminate"] == kept["private"] == kept["packing"] == clean - {310}


def test_nothing_in_gives_nothing_out(spark, nothing):
    """Each stage on an empty table of documents."""
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, "/root/testdata/sf0.001")
        assert out.count() == 0, name
        assert name == "packing" or out.columns == nothing.columns, name
