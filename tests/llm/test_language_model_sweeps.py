"""The pairs' tables are drawn in several Gibbs sweeps, each from the tables of the one before."""

from ratewave.llm import language_model as lm


def test_pairs_are_drawn_in_several_sweeps(spark, monkeypatch):
    rows = [(i, "the cat sat on the mat the cat ran " * (1 + i % 3)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    draw, seen = lm.draw_pairs, []

    def watched(many, contexts, known, scorer, sweep):
        seen.append((sweep, many.agg({"t": "sum"}).first()[0], many.count()))
        return draw(many, contexts, known, scorer, sweep)

    monkeypatch.setattr(lm, "draw_pairs", watched)
    got = lm.language_model_scores(docs).collect()
    assert [s for s, _, _ in seen] == list(range(lm.PAIR_SWEEPS)) and len(seen) >= 3
    assert seen[0][1] == seen[0][2]  # one table for each pair at first
    assert len({n for _, _, n in seen}) == 1  # all pairs in each sweep
    assert sorted(r.doc_id for r in got) == list(range(30))
    assert all(r.score < 0 and r.score > r.base_score for r in got)
