import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from tillroll.llm import packing, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    plain = Tokenizer.from_file(PATH)
    return plain


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(pieces, texts, tokenizer, width=2048):
    """Every id in one piece, in order, windows gapless; returns the number of windows."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_window[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids, at = np.array(ids_of(tokenizer, texts[doc]), "<u4"), 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in by_window.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= width
    order = [(p.sequence_id, p.offset, p.doc_id, p.start) for p in pieces]
    assert [x[2:] for x in sorted(order)] == sorted(x[2:] for x in order)
    return len(by_window)


def test_ids_equal_the_whole_text(tokenizer):
    rng = random.Random(3)
    letters = "aAbzÉéßΣςẞİıﬁ’'.,!?0123…“”()-_%$# \t\n\r\x0b\x0c\x1c\x85 　́é한글漢字😀́"
    encoder = tokens.WordEncoder(PATH)
    texts = ["", " ", "don't we'll I'M", "<|endoftext|> x<|startoftext|>", "a" * 5000, "x" * 50 + " ."]
    texts += ["".join(rng.choice(letters) for _ in range(200)) for _ in range(300)]
    plain = "abthnTHNÀéÿñß×÷İſK'’.,-!?59_ \n"
    texts += ["".join(rng.choice(plain) for _ in range(300)) for _ in range(200)]
    texts += ["".join(rng.choices("aAtsé'.! ", (9, 3, 9, 9, 3, 2, 2, 1, 4), k=400)) for _ in range(100)]
    marks = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", "a", ".", "é"]
    texts += ["".join(rng.choices(marks, k=12)) for _ in range(2000)]
    for text in texts:
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.ids(text).tolist() == expected, repr(text)


def test_ids_of_a_batch_equal_those_of_its_texts(tokenizer):
    rng = random.Random(5)
    bits = ["the", "'S", "'ll", "ing", "ÀÉ", "×", "J\u030c", "İ", "7", "--", "...", "<|", "!", "'"]
    bits += ["<|ENDOFTEXT|>", "<|endoftext|>", "x" * 70, "ab" * 40, " ", " ", " ", "\n", "\x0b", "\x1c"]
    texts = ["", "  ", "q" * 128, "q" * 129, "zy" * 3000, "Don't STOP, it's 1999!!", "word"]
    texts += ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(2000)]
    encoder = tokens.WordEncoder(PATH)
    for of in (texts, texts[:1], texts[2:5], []):
        ids, ends = encoder.batch(pa.array(["cut off", *of], pa.string())[1:])
        assert len(ends) == len(of) + 1 and ends[0] == 0 and ends[-1] == len(ids)
        for text, start, end in zip(of, ends, ends[1:]):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert ids[start:end].tolist() == expected, repr(text)


def test_every_token_is_made_of_its_own_letters(tokenizer):
    # merging by rank equals merging by the listed pairs only if this holds
    model = json.load(open(PATH, encoding="utf-8"))["model"]
    inside = models.BPE(vocab=model["vocab"], merges=[tuple(pair) for pair in model["merges"]])
    for token, number in model["vocab"].items():
        ends = token.endswith("</w>")
        made = tokenizer.model.tokenize(token[:-4]) if ends else inside.tokenize(token)
        assert [t.id for t in made] == [number], token


def test_words_of_a_batch_are_encoded_once_and_together():
    encoder, seen = tokens.WordEncoder(PATH), []

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def encode_to_numpy(self, text):
            seen.append(len(text))
            return self.inner.encode_to_numpy(text)

    encoder.pieces = Counting(encoder.pieces)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    encoder.batch(pa.array([" ".join(words[k:] + words) for k in range(100)]))
    assert seen == [sum(len(word) + 1 for word in words)]


def test_text_groups_keep_rows_in_order_and_sizes_bounded():
    rng = random.Random(11)
    texts = ["é" * rng.choice((0, 0, 10, 90, 400, 3000)) for _ in range(500)]
    table = pa.table({"doc_id": list(range(500)), "text": texts})
    batches = [*table.to_batches(37), table.to_batches()[0].slice(0, 0)]
    groups = list(packing.text_groups(iter(batches), 2000))
    assert [i for g in groups for i in g.column("doc_id").to_pylist()] == list(range(500))
    assert [t for g in groups for t in g.column("text").to_pylist()] == texts
    for group in groups:
        sizes = [len(t.encode()) + packing.ROW_BYTES for t in group.column("text").to_pylist()]
        assert sum(sizes) - max(sizes, default=0) < 2000
    assert len(groups) > 50 and list(packing.text_groups(iter([]))) == []


def test_all_documents_are_packed_with_little_padding(spark, tokenizer):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    pieces = packing.op2_ordered_packing(spark, folder).collect()
    windows = check(pieces, texts, tokenizer)
    total = sum(p.length for p in pieces)
    assert windows * 2048 <= 1.006 * total + 2048 * 8


def test_odd_documents(docs, tokenizer):
    texts = {1: None, 2: "", 3: " \n", 4: "word " * 30_000, 5: "No. Yes! Why?", 6: "x", None: "no id"}
    rows = [*texts.items()]
    pieces = packing.packed(docs(rows).withColumn("start", F.lit(1)), block_tokens=5000).collect()
    assert sum(p.doc_tokens == 1 for p in pieces) == 3
    known = [p for p in pieces if p.doc_id is not None]
    del texts[None]
    firsts = [p for p in pieces if p.doc_id is None]
    assert len(firsts) == 1 and firsts[0].offset == 0
    by_doc = {p.doc_id for p in known}
    assert by_doc == set(texts)
    assert sum(p.length for p in known) == sum(len(ids_of(tokenizer, t)) for t in texts.values())
    repeated = packing.packed(docs([(1, "a b c")] * 3)).collect()
    assert sorted(p.offset for p in repeated) == [0, 4, 8]
    assert packing.packed(docs([])).count() == 0


def cheapest(positions, penalties, width):
    best = [0.0] + [float("inf")] * (len(positions) - 1)
    for j in range(1, len(positions)):
        for i in range(j):
            gap = positions[j] - positions[i]
            if gap <= width:
                best[j] = min(best[j], best[i] + width - gap + penalties[j])
    return best[-1]


def test_cuts_cost_as_little_as_brute_force():
    rng = random.Random(9)
    for _ in range(200):
        positions = [0]
        while len(positions) < rng.randint(2, 40):
            positions.append(positions[-1] + rng.randint(1, 10))
        penalties = [rng.choice((0, 2, 7)) for _ in positions]
        cuts = packing.window_cuts(positions, penalties, 12)
        pairs = list(zip(cuts, cuts[1:]))
        assert cuts[0] == 0 and cuts[-1] == len(positions) - 1
        assert all(positions[b] - positions[a] <= 12 for a, b in pairs)
        cost = sum(12 - positions[b] + positions[a] + penalties[b] for a, b in pairs)
        assert cost == cheapest(positions, penalties, 12)


def test_cuts_prefer_documents_then_sentences():
    ids = np.zeros(500, "<u4")
    ids[[99, 219]] = 7
    ends = np.array([180, 500])
    sentence_ends = np.arange(10) == 7
    positions, penalties = packing.cut_points(ids, ends, sentence_ends)
    found = dict(zip(positions.tolist(), penalties.tolist()))
    assert found[100] == found[220] == 2 and found[180] == found[500] == found[0] == 0
    assert set(found.values()) == {0, 2, packing.HARD_PENALTY} and max(np.diff(positions)) <= 2 * packing.HARD_STEP
