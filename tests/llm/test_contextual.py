import hashlib
import random
import re

from pyspark.sql import functions as F

from tillroll.llm import contextual

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text):
    """(start, kind's place, end) of the fixed kinds."""
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p[-9:]) <= 255 and len(p.lstrip("0")) < 4 for p in m.group().split(".")) if kind == "ip" else 0,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


def base_spans(df):
    return {r.doc_id: [tuple(s) for s in r.base] for r in contextual.personal_data(df).collect()}


def test_base_equals_brute_force(sample_docs):
    texts = {r.doc_id: r.text for r in sample_docs.collect()}
    expected = {i: plain_spans(t) for i, t in texts.items()}
    assert base_spans(sample_docs) == expected and any(expected.values())


def test_odd_texts(docs):
    rng = random.Random(2)
    card = "4111 1111 1111 1111"
    texts = [
        None, "", "no data", "a@b.c_d@e.f@g.h", "x@y", "ééé a.b+c@d-e.fg. Ü 1.2.3.4.5 256.1.1.1 007.08.09.255",
        card, card[:-1] + "2", "1" * 11, "0" * 12, "0" * 20, f"+1 {card}", "+1 (555) 555-0100, +12", "+1+123456789",
        "1-2-3-4-5-6-7-8-9-0-1-2  4111-1111-1111-1111", "00000000000000001.2.3.4", "1.2.3.99999999999999999999",
        "@" * 3000, "a" * 100_000 + "@", "1" * 100_000, "+1" + " " * 50_000 + "x", ("q@r.st " * 5000),
        *("".join(rng.choice("1234567890 -.+()@ab") for _ in range(2000)) for _ in range(20)),
        *("".join(rng.choice("12 -.+@a😀") for _ in range(300)) for _ in range(20)),
    ]
    given = [*enumerate(texts), (None, card), (6, card)]
    found = base_spans(docs(given))
    assert {i: found[i] for i in range(len(texts))} == {i: plain_spans(t) for i, t in enumerate(texts)}
    assert contextual.personal_data(docs(given)).count() == len(given)
    assert contextual.personal_data(docs([])).count() == 0


def planted():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for i in range(40):
        rows.append((i, f"{word()} {word()} call me at +1 555 {i:03d} 2288 today {word()}"))
    for i in range(30):
        rows.append((200 + i, f"{word()} {word()} {word()} mail: {word()}{i}@{word()}.org {word()}"))
        rows.append((300 + i, f"{word()} {word()} order {i}55501{i:02d}7 {word()}"))
    rows.append((102, f"{word()} {word()} {word()} mail: me@localhost {word()}"))
    rows.append((103, f"{word()} {word()} twitter you@localhost {word()}"))
    rows.append((100, "someone wrote call me at 555 010 2299 today, and more"))
    rows.append((101, "the invoice 555 010 2288 4 is unpaid"))
    return rows


def test_unseen_identifiers_are_found_by_context(docs):
    rows = {r.doc_id: r for r in contextual.personal_data(docs(planted())).collect()}
    text = dict(planted())[100]
    (added,) = [s for s in rows[100].spans]
    assert rows[100].base == [] and text[added["start"] : added["end"]] == "555 010 2299"
    assert added["rank"] == contextual.KINDS.index("phone")
    assert rows[101].spans == []
    assert all(len(rows[i].spans) == 1 for i in range(40))
    (added,) = rows[102].spans
    assert added["rank"] == contextual.KINDS.index("email") and rows[102].base == []
    assert rows[103].spans == [] and all(rows[300 + i].spans == [] for i in range(30))


def test_many_unseen_strings_do_not_silence_a_pattern(docs):
    rows = [(i, f"w{i % 7} phone: +1 555 {i:03d} 2288 v{i}x") for i in range(20)]
    rows += [(100 + i, f"u{i % 5} phone: 555 {i:03d} 7799 z{i}x") for i in range(200)]
    rows += [(400 + i, f"t{i % 5} invoice 555 {i:03d} 6611 z{i}x") for i in range(50)]
    # a word that stands before addresses oftener than before phones tells nothing of what follows
    rows += [(500 + i, f"s{i}q number +1 555 {i:03d} 3388 y{i}x") for i in range(20)]
    rows += [(600 + i, f"s{i}r number 4111-1111-1111-1111 y{i}x") for i in range(20)]
    rows += [(700 + i, f"s{i}r number {i}.2.3.4 y{i}x") for i in range(30)]
    rows += [(800 + i, f"s{i}o number 555 {i:03d} 5511 y{i}x") for i in range(20)]
    found = {r.doc_id: r.spans for r in contextual.personal_data(docs(rows)).collect()}
    assert all(len(found[100 + i]) == 1 and found[100 + i][0]["rank"] == 3 for i in range(200))
    assert all(found[400 + i] == [] for i in range(50))
    assert all(found[800 + i] == [] for i in range(20))


def test_accepted_strings_seed_further_patterns(docs):
    rows = [(i, f"a{i}b phone: +1 555 {i:03d} 2288 v{i}x") for i in range(20)]
    # unseen numbers are accepted after "phone:", then lead over "tel" to "fon", each by themselves
    rows += [(100 + i, f"c{i}d phone: 555 {i:03d} 7701 z{i}x") for i in range(20)]
    rows += [(200 + i, f"e{i}f tel 555 {i:03d} 7701 z{i}x") for i in range(20)]
    rows += [(300 + i, f"g{i}h tel 555 {i:03d} 8802 z{i}x") for i in range(20)]
    rows += [(400 + i, f"i{i}j fon 555 {i:03d} 8802 z{i}x") for i in range(20)]
    rows += [(500 + i, f"k{i}l fon 555 {i:03d} 9903 z{i}x") for i in range(5)]
    rows += [(600 + i, f"m{i}n invoice 555 {i:03d} 6604 z{i}x") for i in range(20)]
    found = {r.doc_id: r.spans for r in contextual.personal_data(docs(rows)).collect()}
    assert all([s["rank"] for s in found[i]] == [3] for i, _ in rows if i < 600)
    assert all(found[600 + i] == [] for i in range(20))


UNSEEN = {
    "ip": ["10[.]0[.]0[.]1", "10-0-0-1", "10.0.0[.]1", "fe80::1", "2001:db8:0:0:0:ff00:42:8329", "::ffff"],
    "email": ["name (at) host dot org", "name[at]host.org", "name at host dot org", "me {at} a-b [dot] co [dot] uk"],
    "phone": ["030/1234567", "555\u00a0010\u00a02299", "(030) 123/45 67"],
}
NEVER = {"ip": ["10-0-0-999", "12:30:45", "1:2:3"], "email": ["met at example.org"], "phone": ["1/2/3"]}


def test_other_forms_are_found_by_context(docs):
    seed = {"ip": "10.1.2.{}", "email": "w{}@host.org", "phone": "+1 555 {:03d} 2288"}
    rows, wanted = [], {}
    for kind in seed:
        rows += [(len(rows) + i, f"x{i}y the {kind}s: {seed[kind].format(i)} was seen") for i in range(20)]
        for value in (*UNSEEN[kind], *NEVER[kind]):
            wanted[len(rows)] = (kind, value, value in UNSEEN[kind])
            rows.append((len(rows), f"é the {kind}s: {value} was seen"))
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in contextual.personal_data(docs(rows)).collect()}
    for i, (kind, value, good) in wanted.items():
        at = rows[i][1].index(value)
        span = (at, contextual.KINDS.index(kind), at + len(value))
        assert found[i] == ([span] if good else []), value


def test_redaction(docs):
    texts = [*planted(), (400, "é a@b.cd, +1 555 555 0100 4111-1111-1111-1111 x 1.2.3.4"), (401, None),
             (402, "é a@b.cd, +1 555 555 0100; 4111-1111-1111-1111"), (None, "1.2.3.4 a@b.cc")]
    table = docs(texts).withColumn("spans", F.lit(1))
    out = contextual.redacted(table)
    assert out.columns == table.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[400].text == "é [EMAIL], +1 555 555 0100 4111-1111-1111-1111 x [IP]"
    assert rows[402].text == "é [EMAIL], [PHONE]; [CARD]"
    assert rows[100].text == "someone wrote call me at [PHONE] today, and more"
    assert rows[101].text == dict(texts)[101] and rows[401].text is None
    assert rows[None].text == "[IP] [EMAIL]" and rows[None].n_chars == 12 and len(rows) == len(texts)


def test_query_columns(spark):
    rows = contextual.op4_contextual_pii(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        spans = plain_spans(texts[r.doc_id])
        listed = ",".join(f"{contextual.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]


def spans_of(docs, rows):
    found = contextual.personal_data(docs(rows)).select("doc_id", contextual.span_list(F.col("spans")).alias("s"))
    return {r.doc_id: r.s for r in found.collect()}


def test_long_words_are_contexts_of_their_own(docs):
    """Two words of 80 letters with the same ending are two contexts."""
    one, two = "a" + "z" * 80, "bbb" + "z" * 80
    rows = [(i, f"see {one} 10.0.0.{i} end") for i in range(1, 30)]
    rows += [(50, f"see {one} 10-0-0-1 end"), (51, f"see {two} 10-0-0-2 end"), (52, f"see {two} 10-0-0-2 end")]
    found = spans_of(docs, rows)
    assert found[50] == f"ip:{5 + len(one)}:{5 + len(one) + 8}" and found[51] == found[52] == ""


def test_marks_around_an_address_stay_out(docs):
    rows = [(i, f"mail me{i}@example.org now") for i in range(20)]
    rows += [(30, "mail me@localhost, now"), (31, "mail <you@localhost> now"), (32, "mail me@localhost. now"),
             (33, "mail \"us@intranet\"! now")]
    found = spans_of(docs, rows)
    assert [found[i] for i in (30, 31, 32, 33)] == ["email:5:17", "email:6:19", "email:5:17", "email:6:17"]


def test_dates_are_no_phones(docs):
    rows = [(i, f"call +1 555 010 {2000 + i} now") for i in range(20)]
    rows += [(30, "call 2024-01-15 now"), (31, "on 2024-01-15 we left"), (32, "born 15.01.2024 here"),
             (33, "call 555 010 9999 now"), (34, "room 555 010 9999 there")]
    found = spans_of(docs, rows)
    assert found[30] == found[31] == found[32] == ""
    # one context speaks for the number, so it counts there alone
    assert found[33] == "phone:5:17" and found[34] == ""


def test_a_string_of_several_contexts_counts_everywhere(docs):
    rows = [(i, f"{w} +1 555 010 {2000 + i} now") for i, w in enumerate(["call", "ring"] * 15)]
    rows += [(40, "call 555 010 9999 now"), (41, "ring 555 010 9999 so"), (42, "room 555 010 9999 there")]
    found = spans_of(docs, rows)
    assert all(found[i] == "phone:5:17" for i in (40, 41, 42))
