"""Registered queries against their SQL oracles, or against brute force, over whole tables."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import pytest
from tokenizers import Tokenizer

from ratewave.llm.queries import ORACLES, QUERIES, vocabulary
from tools.check_oracle import compare

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def documents(sf):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()


def rows(spark, name, sf):
    return {r.doc_id: r for r in QUERIES[name](spark, sf).collect()}


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_oracle(spark, name):
    got = compare(spark, SF, [name], verbose=False)[name]
    assert got["ok"] and got["rows"] > 0


def test_mix_is_near_its_targets(spark):
    got = QUERIES["op1_mix_sources"](spark, "/root/testdata/sf0.1").selectExpr("*").toPandas()
    docs = duckdb.sql("SELECT doc_id, source FROM '/root/testdata/sf0.1/documents.parquet'").df()
    per = got.merge(docs, on="doc_id").groupby("source").agg({"taken": "sum", "target": "first", "size": "max", "source_size": "first"})
    assert abs(per.target.sum() - 1.5 * got["size"].sum()) < 1e-3
    assert ((per.taken - per.target).abs() <= per["size"]).all()  # within one document
    assert (got.taken <= 2 * got["size"]).all() and got.taken.sum() <= 1.5 * got["size"].sum()


def test_bpe_ids_and_decoding(spark):
    t = Tokenizer.from_file(vocabulary())
    got = rows(spark, "op2_bpe_encode", SF)
    counts = rows(spark, "op6_count_tokens", SF)
    for doc_id, text in documents(SF):
        ids = t.encode(text or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        decoded = t.decode(ids, skip_special_tokens=False)
        assert got[doc_id].n_tokens == counts[doc_id].n_tokens == len(ids)
        assert got[doc_id].ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert counts[doc_id].n_bytes == len((text or "").encode())
        assert counts[doc_id].over_limit == (len(ids) > 1024)


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(docs):
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = collections.defaultdict(list)
    for d, s in sets.items():
        shared = collections.Counter(o for sh in s for o in index[sh])
        for o, n in shared.items():
            if 100 * n >= 85 * (len(s) + len(sets[o]) - n):
                a, b = sorted((find(d), find(o)))
                parent[b] = a
        for sh in s:
            index[sh].append(d)
    return sets, {d: find(d) for d in sets}


def test_near_duplicates(spark):
    sets, comp = brute_components(documents(SF))
    for d, r in rows(spark, "op4_near_duplicates", SF).items():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[d]), comp[d], comp[d] == d)


def brute_removal(docs, window):
    words = {d: (t or "").encode().split() for d, t in docs}
    seen = collections.Counter(tuple(w[i : i + window]) for w in words.values() for i in range(len(w) - window + 1))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out[d] = (len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone, strict=True) if not g)).hexdigest())
    return out


def test_substring_dedup(spark):
    want = brute_removal(documents(SF), 35)
    got = rows(spark, "op5_substring_dedup", SF)
    assert {d: (r.n_words, r.n_removed, r.kept_sha256) for d, r in got.items()} == want
    assert sum(w[1] for w in want.values()) > 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = rows(spark, "op7_toxicity", sf)
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    held = {d: r for d, r in got.items() if r.held_out}
    assert all((zlib.crc32(str(d).encode()) % 5 == 0) == r.held_out for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    toxic = [r.predicted for d, r in held.items() if labels.get(d) == 1]
    clean = [r.predicted for d, r in held.items() if labels.get(d) == 0]
    assert sum(toxic) / len(toxic) > 0.88 and sum(clean) / len(clean) < 0.02


SECRETS = [
    (
        "assign",
        re.compile(
            r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
            r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
        ),
    ),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
]


def brute_secrets(text):
    out = []
    for order, (kind, pattern) in enumerate(SECRETS):
        for m in pattern.finditer(text or ""):
            if {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}[kind]():
                out.append((m.start(), order, m.end(), kind))
    return sorted(out)


def test_secret_scan(spark):
    got = rows(spark, "op8_secret_scan", SF)
    total = 0
    for d, t in documents(SF):
        want = brute_secrets(t)
        total += len(want)
        joined = [f"{k}:{a}:{b}" for a, _, b, k in want]
        r = got[d]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w[3] == k for w in want) for k in ("assign", "access", "hex"))
        assert set(joined) <= set(r.spans.split(",")) | {""}
    assert total > 0


def test_language_model(spark):
    tokens = {d: (t or "").encode().translate(LOWER).split() + [None] for d, t in documents(SF)}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    counts = collections.Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    n, v = sum(counts.values()), len(counts)
    got = rows(spark, "op9_language_model", SF)
    sums = {True: [0.0, 0.0], False: [0.0, 0.0]}
    for d, ws in tokens.items():
        r = got[d]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)
        assert r.base_score == pytest.approx(base, abs=1e-6, rel=1e-9)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[d], len(ws), n)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        sums[held[d]][0] += base
        sums[held[d]][1] += r.score
    assert all(score > base for base, score in sums.values())  # a lower perplexity, held out too


def test_fingerprints(spark):
    docs = sorted(documents(SF), reverse=True)
    got = rows(spark, "op10_fingerprints", SF)
    errors = []
    for i, (d, t) in enumerate(docs):
        t, following = t or "", docs[(i + 1) % len(docs)][1] or ""
        m = len(t) // 2
        new = t[: len(t) - m] + following[:m]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        for near, other in ((r.near_edited, new), (r.near_next, following)):
            a, b = shingles(t), shingles(other)
            errors.append(abs(near - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.02
    same = collections.defaultdict(set)
    for d, t in docs:
        same[t].add(got[d].fingerprint)
    assert all(len(v) == 1 for v in same.values())
