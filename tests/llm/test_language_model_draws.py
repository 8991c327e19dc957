"""Scores use all draws of the pairs' tables, not the last one alone."""

import numpy as np

from ratewave.llm import language_model as lm


def test_scores_use_the_mean_of_all_draws(spark, monkeypatch):
    rows = [(i, "the cat sat on the mat the cat ran on a mat " * (1 + i % 3)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    draw, fit, score, drawn, fitted, used = lm.draw_pairs, lm.fit_levels, lm.pair_tables, [], [], {}

    def draws(*a):
        out = lm.materialize(draw(*a), "test_draws")
        drawn.append({(r.u, r.w): r.t for r in out.collect()})
        return out

    def fits(*a):
        scorer, known = fit(*a)
        fitted.append(scorer)
        return scorer, known

    def tables(pairs, many, once):
        used.update({(r.u, r.w): r.t for r in many.collect()}, once=once)
        return score(pairs, many, once)

    monkeypatch.setattr(lm, "draw_pairs", draws)
    monkeypatch.setattr(lm, "fit_levels", fits)
    monkeypatch.setattr(lm, "pair_tables", tables)
    assert lm.language_model_scores(docs).count() == 40
    assert used.pop("once") == len(drawn) == lm.PAIR_SWEEPS and len(fitted) == lm.PAIR_SWEEPS + 1
    assert used == {k: sum(x[k] for x in drawn) for k in drawn[0]}
    mean = lm.Scorer.mean(fitted[1:])
    assert mean.draws == lm.PAIR_SWEEPS and np.allclose(mean.classes.sum(axis=1), 1)
    assert np.allclose(mean.tables, sum(x.tables for x in fitted[1:]) / lm.PAIR_SWEEPS)
    assert np.isclose(10.0**mean.unknown, np.mean([10.0**x.unknown for x in fitted[1:]]))
