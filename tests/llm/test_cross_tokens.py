"""Cross-tokenizer alignment against whole encodings by the libraries and plain loops."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ratewave.llm import cross_tokens as M
from ratewave.llm.common import byte_alphabet
from ratewave.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"
PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIB_B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)
TOOL = M.cross_tokens(PATH_A, PATH_B)
CHARS = byte_alphabet()


def plain_a():
    """The library's encoder without its special strings."""
    import json

    with open(PATH_A, encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"] = []
    return tokenizers.Tokenizer.from_str(json.dumps(spec))


LIB_A = plain_a()


def whole(text):
    """(A ids, A bytes, B ids, B bytes), or None where there are no tokens."""
    if not text:
        return None
    a = LIB_A.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(CHARS[c] for c in LIB_A.id_to_token(i)) for i in a]
    b = LIB_B.encode(text, out_type=int)
    bytes_b = [bytes([int(LIB_B.id_to_piece(i)[3:5], 16)]) if LIB_B.is_byte(i) else LIB_B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    raw = (" " + text).encode()
    return (a, bytes_a, b, bytes_b) if b"".join(bytes_a) == raw == b"".join(bytes_b) else None


def ends_of(tokens):
    return np.cumsum([len(x) for x in tokens]).tolist()


def brute(text):
    """(n_a, n_b, groups as text, pairs of the links) by plain loops over the whole encoding."""
    got = whole(text)
    if got is None:
        return 0, 0, "", []
    a, bytes_a, b, bytes_b = got
    ends_a, ends_b = ends_of(bytes_a), ends_of(bytes_b)
    common = sorted(set(ends_a) & set(ends_b))
    groups, i, j = [], 0, 0
    for e in common:
        i2, j2 = bisect_left(ends_a, e) + 1, bisect_left(ends_b, e) + 1
        groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
        i, j = i2, j2
    links, j = [], 0
    for i, x in enumerate(a):
        lo, hi = (ends_a[i - 1] if i else 0), ends_a[i]
        while ends_b[j] <= lo:
            j += 1
        k = j
        while k < len(b) and (ends_b[k - 1] if k else 0) < hi:
            links.append((x, b[k]))
            k += 1
    return len(a), len(b), ";".join(groups), links


def aligned(texts):
    out = []
    for n_a, n_b, n_groups, pairs, groups in M.align_texts(TOOL, [t.encode() for t in texts]):
        assert n_groups == (groups.count(";") + 1 if groups else 0)
        out.append((n_a, n_b, groups, Counter((int(p) >> 32, int(p) & 0xFFFFFFFF) for p in pairs)))
    return out


ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b\n", "\n", "\t x", "x  y", "x  　y", "\x1c a \x85 b",
    "▁", "a▁b", "a ▁", "<s> </s> <unk> <0x41>", "<|endoftext|> x", "don't 've 'll", "\x00", "a\x00 b",
    "漢字かな 漢", "é \U0001f600\U0001f600 x", "=" * 500, "x" * 3000 + " " + "漢" * 800, " " * 300 + "a", "a" + " " * 300,
]


def test_odd_texts_together_and_alone():
    want = [(a, b, g, Counter(x)) for a, b, g, x in map(brute, ODD)]
    assert aligned(ODD) == want
    assert [aligned([t])[0] for t in ODD] == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\tab.,'1=▁ 　é漢"), st.characters(exclude_categories=["Cs"])), max_size=40), min_size=1, max_size=4))
def test_any_texts(texts):
    assert aligned(texts) == [(a, b, g, Counter(x)) for a, b, g, x in map(brute, texts)]


def test_cuts_are_the_common_ends():
    rnd = random.Random(1)
    for _ in range(60):
        first_a, first_b, ends_a, ends_b, base = [0], [0], [], [], 0
        for _ in range(rnd.randint(1, 5)):
            size = rnd.randint(1, 60)
            for ends, first in ((ends_a, first_a), (ends_b, first_b)):
                ends += sorted({base + x for x in rnd.sample(range(1, size + 1), rnd.randint(0, size))} | {base + size})
                first.append(len(ends))
            base += size
        inner = (set(ends_a) & set(ends_b)) - {ends_a[i - 1] for i in first_a[1:]}
        a, b = M.shared_cuts(*(np.array(x) for x in (ends_a, ends_b, first_a, first_b)))
        assert [ends_a[i] for i in a] == [ends_b[i] for i in b] == sorted(inner)


def expected(rows):
    found = [brute(t) for _, t in rows]
    counts = Counter(p for f in found for p in f[3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (i, _), (n_a, n_b, groups, links) in zip(rows, found, strict=True):
        best = sum(counts[p] == most[p[1]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        out.append((i, n_a, n_b, groups.count(";") + 1 if n_a else 0, len(links), best, sum(counts[p] for p in links), digest))
    return sorted(out, key=str)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("head", [M.HEAD, 40, 0])
def test_corpus_counts_of_odd_rows(spark, monkeypatch, head):
    monkeypatch.setattr(M, "HELD", 50)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a b a"), (None, None), (3, "a b a"), (3, "a b a"), (4, "the long " * 400)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, pair string, row string").repartition(3)
    got = M.corpus_links(M.align_documents(docs, PATH_A, PATH_B, digest=True), head).withColumnRenamed("groups", "groups_sha256")
    assert sorted((tuple(r) for r in got.select(NAMES).collect()), key=str) == expected([(i, t or "") for i, t in rows])


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert M.corpus_links(M.align_documents(none, PATH_A, PATH_B)).collect() == []


def test_registered_query(spark):
    rows = duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF001}/documents.parquet'").fetchall()
    got = QUERIES["op13_cross_token_alignment"](spark, SF001)
    assert sorted((tuple(r) for r in got.select(NAMES).collect()), key=str) == expected(rows)
    assert got.agg(F.sum("n_a") > 0).first()[0]
