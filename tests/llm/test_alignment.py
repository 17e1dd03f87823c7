"""Alignment against whole-text encoding and a plain intersection of ends."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tillroll.llm import alignment

FOLDER = "/root/testdata/sf0.001"
A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B_PATH)


def letters():
    """Bytes of the letters of byte-level vocabularies."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def plain_groups(text, tools):
    a, b = tools
    if not text:
        return []
    table = letters()
    encoded = a.encode(" " + text, add_special_tokens=False)
    first = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in encoded.ids]
    second = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        second.append((i, bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if any(b"".join(t for _, t in s) != whole for s in (first, second)):
        return []
    ends = []
    for s in (first, second):
        at, found = 0, {}
        for n, (_, t) in enumerate(s):
            at += len(t)
            found[at] = n + 1
        ends.append(found)
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        groups.append(([x for x, _ in first[i : ends[0][end]]], [x for x, _ in second[j : ends[1][end]]]))
        i, j = ends[0][end], ends[1][end]
    return groups


def plain(rows, tools):
    """Expected rows of the query for (doc_id, text) rows."""
    groups = [plain_groups(text, tools) for _, text in rows]
    links = [Counter((a, b) for g in found for a in g[0] for b in g[1]) for found in groups]
    count = Counter(pair for found in links for pair in found)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _), found, linked in zip(rows, groups, links):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in found)
        out.append((
            i, sum(len(a) for a, _ in found), sum(len(b) for _, b in found), len(found),
            sum(linked.values()), sum(n for p, n in linked.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in linked.items()),
            hashlib.sha256(spelled.encode()).hexdigest() if found else "",
        ))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def found(df):
    return ordered(tuple(r) for r in df.select(COLUMNS).collect())


def test_query_equals_plain_alignment(spark, sample_docs, tools):
    rows = [(r.doc_id, r.text) for r in sample_docs.collect()]
    assert found(alignment.op12_shared_cuts(spark, FOLDER)) == ordered(plain(rows, tools))


ODD = [
    None, "", " ", "  ", "a", "a  b", " a b ", "x\n y", "x\n \ny", "x \ny", "a  b", "a  b", "tab\t\tx ",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "with ▁ inside", "▁", "\x00 nul", "\U0001f600 中文 é é",
    "don't we'LL 12345 x1y2", "-" * 5000, "ab" * 3000, "=" * 77 + " " + "~" * 33, "   x", "\r\n \r\n",
    "word " * 3000, "　　", "​ ‍", "x\x1c y", "a \x85 b",
]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 10])
def test_odd_texts(spark, docs, tools, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    rows = [*enumerate(ODD), (4, "a"), (4, "a"), (None, "a b"), (None, None)]
    table = docs(rows)
    for name in ("row", "pair", "pairs", "count", "numbers", "n_a", "best"):
        table = table.withColumn(name, F.lit("x"))
    got = found(alignment.Links.of(table, A_PATH, B_PATH).documents_with_counts())
    assert got == ordered(plain(rows, tools))
    assert found(alignment.Links.of(table.filter("false"), A_PATH, B_PATH).documents_with_counts()) == []


def test_random_texts(tools, monkeypatch):
    monkeypatch.setattr(alignment, "LINKS_AT_ONCE", 50)
    random.seed(5)
    alphabet = ["the", "of", "un", "x", "Zq", "é", "中", "7", "'s", ".", "\n", "\t", " ", " ", " ", " ", "  ",
                " ", "▁", "<s>", "\U0001f600", "--", "\x00", ", ", ".'", "É", "×", "ing", "tion", "<0x0A>"]
    texts = ["".join(random.choices(alphabet, k=random.randrange(40))) for _ in range(3000)]
    first, second = alignment.byte_level(A_PATH), alignment.pieces(B_PATH)
    got = alignment.Aligned.of(texts, alignment.Encoders(first, second))
    groups, (links, _) = got.group_bounds(), got.link_numbers()
    codes, numbers, bounds = got.pairs(len(second.spelled), len(first.spelled))
    for k, text in enumerate(texts):
        expected, cuts, a0, b0 = plain_groups(text, tools), [], got.a_bounds[k], got.b_bounds[k]
        for g in range(groups[k], groups[k + 1]):
            cuts.append((list(got.a[a0 : got.a_cuts[g]]), list(got.b[b0 : got.b_cuts[g]])))
            a0, b0 = got.a_cuts[g], got.b_cuts[g]
        assert cuts == expected, text
        pairs = Counter(a * len(second.spelled) + b for g in expected for a in g[0] for b in g[1])
        assert dict(zip(codes[bounds[k] : bounds[k + 1]], numbers[bounds[k] : bounds[k + 1]])) == pairs


def test_long_interval_without_cuts():
    """Ends of A at odd offsets, of B at even ones, but for one shared end far from the middle."""
    a = np.array([*range(1, 40001, 2), 40002, *range(40003, 40200, 2), 40200])
    b = np.array([*range(2, 40001, 2), 40002, *range(40004, 40201, 2)])
    a_cuts, b_cuts = alignment.shared_cuts(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    shared = np.intersect1d(a, b)
    assert list(a[a_cuts - 1]) == list(shared) and list(b[b_cuts - 1]) == list(shared)


def test_real_outputs(spark, docs, tools):
    rows = [(1, "some unbelievable tokenisation"), (2, None)]
    got = {r.doc_id: r for r in alignment.alignments(docs(rows), A_PATH, B_PATH).collect()}
    r, expected = got[1], plain_groups(rows[0][1], tools)
    assert r.a_ids == [i for g in expected for i in g[0]] and r.b_ids == [i for g in expected for i in g[1]]
    assert r.a_cuts == list(np.cumsum([len(g[0]) for g in expected])) and len(r.b_cuts) == len(expected)
    assert got[2].a_ids == [] and got[2].b_cuts == []
