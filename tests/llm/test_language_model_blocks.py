"""Pairs that the training holds once are never written; blocks find the counts of all their pairs."""

import collections

from pyspark.sql import functions as F

from ratewave.llm import language_model as lm

TRAIN, HELD = 2, 1  # crc32("1") mod 7 is 2


def test_pairs_seen_once_are_not_written(spark, monkeypatch):
    rows = [(TRAIN, " ".join(f"w{i}" for i in range(3_000)) + " a b a b"), (HELD, "w1 w2 a b")]
    real, written = lm.materialize, {}

    def watched(df, name):
        out = real(df, name)
        written.setdefault(name, out.count())
        return out

    monkeypatch.setattr(lm, "materialize", watched)
    got = lm.language_model_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.held_out, r.n_tokens, r.n_known) for r in got} == {(TRAIN, False, 3_005, 3_005), (HELD, True, 5, 5)}
    assert written["lm_pairs"] < 100 and written["lm_tables"] < 10  # 3,004 pairs, of which "a b" is seen twice


def test_blocks_find_the_counts_of_their_pairs(spark):
    texts = {4: "a b a b a c", 2: "a b x y", 3: None, HELD: "a b a z x y y"}
    rows = [(i, t, i == HELD) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3)
    codes = lm.Codes.of([b"a", b"b", b""])
    blocks = lm.materialize(lm.blocks_of(docs, codes), "test_blocks")
    pairs = lm.materialize(lm.count_pairs(blocks, 2), "test_pairs")
    many = pairs.where("block is null").withColumn("t", F.lit(1).cast("long"))

    code = lambda w: int(codes(lm._hashes([w.encode()]))[0])
    want = collections.Counter()
    for i, t in texts.items():
        words = ["", *(t or "").split(), ""]
        want.update((code(u), code(w)) for u, w in zip(words, words[1:], strict=False) if i != HELD)
    assert {(r.u, r.w): r.c for r in many.collect()} == {k: c for k, c in want.items() if c > 1}
    found = collections.defaultdict(list)
    for r in sorted(lm.pair_tables(pairs, many).collect(), key=lambda r: r.bucket):
        assert (lm._unpacked(r.t) == (lm._unpacked(r.c) > 0)).all()
        found[r.block].extend(lm._unpacked(r.c).tolist())
    for batch in blocks.toArrow().to_batches():
        for r, block in lm._read(batch):
            u, w, _, _ = block.distinct()
            assert found[r["block"]] == [want[x] for x in zip(u.tolist(), w.tolist(), strict=True)]
