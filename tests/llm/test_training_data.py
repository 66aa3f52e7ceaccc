"""Training-data operators against brute force on small fixtures."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import defaultdict
from datetime import date

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from lexicrate.llm import (embedding, exact, language, mixing, packing, pii, quality, simhash,  # noqa: E402
                           suffixes, toxicity)
from lexicrate.llm.components import components, join_labels  # noqa: E402
from lexicrate.llm.queries import ORACLES, QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORDS = "the of red rend and thing over edat river stone light water paper cloud green wheel onst house".split()
SCHEMA = "doc_id long, text string, source string, lang string, kept string, h string, row string, size string"


def words(r, n):
    return " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))


def odd_rows(seed=0):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    r = random.Random(seed)
    long = words(r, 9000)
    texts = [None, "", " ", "a", "a b", "A  b", "a\tb", long, long + " end", "x" * 5000, words(r, 60), "é" * 300, "a b", "\x1fa"]
    texts += [words(r, 40) for _ in range(12)] * 2 + [long[:4000], long[100:3000]] + ["copy of one text"] * 40
    rows = [(i, t, r.choice(["s1", "s2", "sé", None]), "en", "k", "h", "r", "z") for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (None, "copy of one text", None, None, None, None, None, None), (None, "lone", "s1", None, None, None, None, None), (3, "other text, same id", "s2", None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in range(45)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    got = QUERIES[name](spark, SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()[list(got.columns)]
    order = list(got.columns)
    a, b = (x.sort_values(order).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b) and all((a[c] == b[c]).all() for c in order)


def norm(t):
    return re.sub("[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("hot_rows", [64, 5])
def test_exact_dedup(docs, monkeypatch, hot_rows):
    monkeypatch.setattr(exact, "HOT_ROWS", hot_rows)  # 5: the copies are salted
    got = exact.exact_dedup(docs).collect()
    groups = defaultdict(list)
    for r in odd_rows():
        groups[norm(r[1])].append(r[0])
    assert len(got) == len(odd_rows())
    for g in groups.values():
        keep = min((i for i in g if i is not None), default=None)
        sha = [hashlib.sha256(k.encode()).hexdigest() for k, v in groups.items() if v is g][0]
        own = [x for x in got if x.text_sha256 == sha]
        assert sorted(map(str, (x.doc_id for x in own))) == sorted(map(str, g))
        assert {(x.keep_id, x.group_size) for x in own} == {(keep, len(g))}
        assert [x.doc_id for x in own if x.kept] == [keep]
    kept = exact.exact_dedup(docs, carry=True).where("kept").select("row.*")
    assert kept.columns == docs.columns and kept.count() == len(groups)


def brute_fingerprint(t):
    w = re.findall("[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_golay_keys_meet_within_two_bits():
    tables, g = simhash.golay_tables(), np.random.default_rng(1)
    assert len(set(np.bitwise_count(simhash.codewords()))) and np.bitwise_count(simhash.codewords()[1:]).min() == 7
    a = g.integers(0, 1 << 63, 2000, np.uint64) * 2
    b = a ^ (np.uint64(1) << g.integers(0, 64, 2000).astype(np.uint64)) ^ (np.uint64(1) << g.integers(0, 64, 2000).astype(np.uint64))
    ka, kb = ([set() for _ in a] for _ in range(2))
    for s, x in ((ka, a), (kb, b)):
        for r, k in zip(*simhash.keys(x, tables)):
            s[r].add(int(k))
    assert all(x & y for x, y in zip(ka, kb))


@pytest.mark.parametrize("small,ball", [(16, 16384), (2, 16384), (2, 3)])
def test_simhash_links(spark, monkeypatch, small, ball):
    monkeypatch.setattr(simhash, "SMALL", small)  # the middle and the ball path
    g = np.random.default_rng(2)
    base = g.integers(0, 1 << 62, 6)
    fps = sorted({int(x) for b in base for x in [b, *[b ^ (1 << int(i)) for i in g.integers(0, 62, 8)], *[b ^ (1 << int(i)) ^ (1 << int(j)) ^ (1 << int(k)) for i, j, k in g.integers(0, 62, (8, 3))]]})
    rows = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, rep long")
    found = {r.node: r.component for r in components(simhash.links(rows, ball_above=ball)).collect()}
    u, v = np.nonzero(np.bitwise_count(np.array(fps)[:, None] ^ np.array(fps)) <= 2)
    want = join_labels(len(fps), u, v)
    assert [found.get(i, i) for i in range(len(fps))] == want.tolist()


def test_simhash(docs):
    got = simhash.near_duplicates(docs).collect()
    rows = odd_rows()
    fp = [brute_fingerprint(r[1]) for r in rows]
    assert sorted((str(r[0]), f"{f:016x}") for r, f in zip(rows, fp)) == sorted((str(x.doc_id), x.fingerprint) for x in got)
    known = [(r[0], f) for r, f in zip(rows, fp) if r[0] is not None]
    f = np.array([x for _, x in known], np.uint64)
    label = join_labels(len(f), *np.nonzero(np.bitwise_count(f[:, None] ^ f) <= 2))
    least = {c: min(known[i][0] for i in range(len(f)) if label[i] == c) for c in set(label.tolist())}
    assert sorted((known[i][0], least[c]) for i, c in enumerate(label.tolist())) == sorted((x.doc_id, x.component_id) for x in got if x.doc_id is not None)


def brute_repeats(rows, n=100):
    order = sorted({(2**63 - 1 if i is None else i, xxhash.xxh64_intdigest((t or "").encode(), 42), (t or "").encode()) for i, t in rows},
                   key=lambda x: (x[0], x[1] - (1 << 64 if x[1] >> 63 else 0)))
    seen, out = set(), {}
    for i, h, b in order:
        gone = bytearray(len(b))
        for s in range(len(b) - n + 1):
            if b[s:s + n] in seen:
                gone[s:s + n] = b"\1" * n
            seen.add(b[s:s + n])
        out[i, b] = bytes(x for x, g in zip(b, gone) if not g), len([1 for x in bytes(gone).split(b"\0") if x])
    return out


@pytest.mark.parametrize("many", [1 << 16, 1])
def test_suffixes(spark, docs, many):
    rows = [(r[0], r[1]) for r in odd_rows()]
    want = brute_repeats(rows)
    got = suffixes.remove_repeats(docs, many=many).select("doc_id", "n_bytes", "kept", F.size("spans").alias("n")).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for (i, b), (kept, n) in want.items():
        by[i].append((len(b), kept, n))
    for x in got:
        assert (x.n_bytes, bytes(x.kept), x.n) in by[2**63 - 1 if x.doc_id is None else x.doc_id]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=6), max_size=8), min_size=1, max_size=6))
def test_loser_tree(runs):
    coded = []
    for run in runs:
        run, last, out = sorted(x.encode() for x in run), b"", []
        for s in run:
            out.append((suffixes.common(last, s, 0) if out else 0, s))
            last = s
        coded.append(iter(out))
    merged = list(suffixes.merge(coded))
    assert [s for _, s, _ in merged] == sorted(x.encode() for run in runs for x in run)
    assert all(n == suffixes.common(a[1], s, 0) for a, (n, s, _) in zip(merged, merged[1:]))


def test_embedding(spark):
    g = np.random.default_rng(3)
    base = g.normal(size=(30, 8))
    vecs = [(base[i % 30] + g.normal(scale=0.08, size=8)).tolist() for i in range(200)]
    rows = [(i, v, i % 2) for i, v in enumerate(vecs)] + [(200 + i, vecs[0], 0) for i in range(20)]
    rows += [(300, None, 0), (301, [0.0] * 8, 0), (302, [float("nan")] * 8, 0), (303, [None] * 8, 0), (304, vecs[0], None), (305, [], 0), (306, [1e300] * 8, 0), (307, vecs[0][:3], 0), (308, vecs[0], 5)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, cell string")
    got = {x.vec_id: x for x in embedding.near_duplicates(df, part=16).collect()}
    assert len(got) == len(rows)
    ok = [(i, np.array(v), l) for i, v, l in rows if l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(a, b) for a, (_, x, k) in enumerate(ok) for b, (_, y, m) in enumerate(ok) if a != b and k == m and len(x) == len(y)
             and (x / np.abs(x).max()) @ (y / np.abs(y).max()) / np.linalg.norm(x / np.abs(x).max()) / np.linalg.norm(y / np.abs(y).max()) >= 0.98]
    label = join_labels(len(ok), np.array([a for a, _ in links]), np.array([b for _, b in links]))
    count = np.bincount([a for a, _ in links], minlength=len(ok))
    for a, (i, _, _) in enumerate(ok):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (count[a], ok[label[a]][0], label[a] == a)
    assert all((x.n_links, x.component_id) == (0, x.vec_id) for i, x in got.items() if i not in {o[0] for o in ok})


def test_embedding_with_repeated_ids(spark):
    """Vectors that share an id are nodes of their own; so are equal vectors of two labels."""
    rows = [(5, [1.0, 0.0, 0.0], 0), (5, [0.0, 1.0, 0.0], 0), (3, [0.0, 1.0, 0.01], 0), (7, [1.0, 0.0, 0.01], 0), (3, [1.0, 0.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1)]
    got = embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(map(tuple, got)) == sorted([(5, 1, 5, True), (5, 1, 3, False), (3, 1, 3, True), (7, 1, 5, False), (3, 1, 3, True), (9, 1, 3, False)])


def test_mixing(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == len(odd_rows())
    size = lambda t: len(re.findall("[^\x20\x09-\x0D]+", t or ""))
    total, cap = defaultdict(int), {}
    for r in odd_rows():
        total[r[2]] += size(r[1])
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    while True:
        rest = sum(total.values()) - sum(cap.values())
        open_ = [s for s in names if s not in cap]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * total[s]]
        if not over:
            break
        cap |= {s: 3 * total[s] for s in over}
    want = {total[s]: round(float(cap.get(s, share.get(s, 0))), 6) for s in names}
    assert {(x.source_size, x.target) for x in got} == set(want.items())
    taken = defaultdict(int)
    for x in got:
        taken[x.source_size] += x.taken
        assert 0 <= x.taken <= 3 * x.size
    assert all(taken[s] == int(t + 0.5) for s, t in want.items())
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    assert sum(size(x.text) for x in out.select("text").collect()) == sum(x.taken for x in got)
    plain = spark.createDataFrame([(i, words(random.Random(i), 5 + i % 7), f"s{i % 3}") for i in range(60)], "doc_id long, text string, source string")
    mixed = defaultdict(int)
    for x in mixing.mixed_rows(plain).collect():
        mixed[x.doc_id] += size(x.text)
    assert {x.doc_id: x.taken for x in mixing.mix(plain).collect() if x.taken} == dict(mixed)


def test_packing(spark, docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    odd = ["It's <|endoftext|> 3rd’s ÆØ ﬁne İ Σας x'll 'll", "a" * 400, "ÀÉ$$$ don't—stop... 北京 été", None]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    every = docs.select("doc_id", "text").union(more)
    got = packing.pack_documents(every, TOKENIZER, group=20).collect()
    want = []
    for i, t in [(r[0], r[1]) for r in odd_rows()] + [(1000 + i, t) for i, t in enumerate(odd)]:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want += [(str(i), k, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    assert sorted((str(x.doc_id), x.piece, x.start, x.length, x.ids_crc32) for x in got) == sorted(want)
    seqs = defaultdict(list)
    for x in got:
        seqs[x.sequence_id].append((x.offset, x.length))
    for s in seqs.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))] and sum(n for _, n in s) <= 4096


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bin_completion_is_optimal(sizes):
    bins = packing.bin_completion(sizes, 20, nodes=100000)
    assert sorted(x for b in bins for x in b) == sorted(sizes) and all(sum(b) <= 20 for b in bins)

    def least(rest, rooms):
        if not rest:
            return len(rooms)
        return min(least(rest[1:], (*rooms[:i], r - rest[0], *rooms[i + 1:])) for i, r in enumerate((*rooms, 20)) if r >= rest[0] and (i < len(rooms) or True))
    if len(sizes) <= 7:
        assert len(bins) == least(tuple(sorted(sizes, reverse=True)), ())


def test_bin_completion_beats_best_fit():
    sizes = [100, 98, 96, 93, 91, 87, 81, 59, 58, 55, 50, 43, 22, 21, 20, 15, 14, 10, 8, 6, 5, 4, 3, 1, 0 + 4]
    assert len(packing.bin_completion(sizes, 100)) <= len(packing.best_fit(sizes, 100))


VALUES = {"card": "4111 1111 1111 1111", "ipv4": "10.0.255.1", "email": "jo.smith9@mail.example.com", "ssn": "078-05-1120", "phone": "+1 (613) 555-6237", "date": "1987-03-09"}


def test_pii(spark):
    rows = [(i, f"start {v} end. {v}", k, "x") for i, (k, v) in enumerate(VALUES.items())]
    rows += [(20, None, "", "x"), (21, "", "", "x"), (22, "4111 1111 1111 1112 and 300.1.1.1 and 000-11-1111 and 2001-02-30", "", "x"), (23, "no 12345678901234567890123 here", "", "x"),
             (24, "09/03/1987 3/9/1987 9.3.1987 4111111111111111", "date,card", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, want string, kinds string")
    got = {x.doc_id: x for x in pii.pseudonymise(df, "key").collect()}
    for i, t, k, _ in rows[:6]:
        v = VALUES[k]
        m = re.fullmatch(r"start (.+) end\. (.+)", got[i].text)
        assert m[1] == m[2] != v and got[i].kinds == [k, k] and got[i].n_replaced == 2
        assert re.sub("[0-9]", "0", m[1]) == re.sub("[0-9]", "0", v) or k in ("email", "ipv4")
    assert sum(2 * int(d) - 9 * (int(d) > 4) if i % 2 else int(d) for i, d in enumerate(re.sub(r"\D", "", got[0].text.split(" end")[0])[::-1])) % 10 == 0
    assert got[20].text is None and got[20].n_replaced == 0
    assert all(got[i].text == t and not got[i].kinds for i, t, *_ in rows if i in (21, 22, 23))
    assert re.sub(r"\D", "", got[0].text.split(" end")[0]) in got[24].text  # the same card without spaces stays linked
    year = date.fromisoformat(re.search(r"\d{4}-\d\d-\d\d", got[5].text)[0])
    assert f"{year.month}/{year.day}/{year.year}" not in got[24].text.split()[0] and f"{year.day}.{year.month}.{year.year}" in got[24].text


def test_pii_cards_among_numbers(spark):
    """A valid card is found whatever numbers stand before or after it, and other kinds keep what it leaves."""
    a, b, phone = "4111 1111 1111 1111", "5500-0000-0000-0004", "415-555-2671"
    texts = [a, a + " 03/27", "4111111111111111 123", "4111111111111111 03 27 123", f"{a} 123 {b} 456", f"{b} {a}", f"12 {a} 7", f"{a} 01/02/2027",
             f"{phone} {a} {phone}", "3782 822463 10005 1234", a[:-1] + "2 03/27", "\ue000a4111 1 \ue000", "41 11 11 11 11 11 11 11 03"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: (x.text, x.kinds) for x in pii.pseudonymise(df, "key").collect()}
    new = got[0][0]
    assert new != a and re.sub("[0-9]", "0", new) == re.sub("[0-9]", "0", a)
    assert got[1] == (new + " 03/27", ["card"])
    assert got[2] == (new.replace(" ", "") + " 123", ["card"]) and got[3] == (new.replace(" ", "") + " 03 27 123", ["card"])
    other = got[5][0].split(" ")[0]
    assert other != b and got[4] == (f"{new} 123 {other} 456", ["card"] * 2) and got[5] == (f"{other} {new}", ["card"] * 2)
    assert got[6] == (f"12 {new} 7", ["card"])
    assert got[7][0].startswith(new + " ") and got[7][1] == ["card", "date"] and "2027" not in got[7][0]
    assert got[8][1] == ["phone", "card", "phone"] and new in got[8][0] and phone not in got[8][0]
    assert got[9][1] == ["card"] and got[9][0].endswith(" 1234") and not got[9][0].startswith("3782 8")
    assert got[10] == (texts[10], []) and got[11] == (texts[11], [])
    assert got[12][1] == ["card"] and re.sub(r"\D", "", got[12][0]) == re.sub(r"\D", "", new) + "03"


def test_pii_notations_of_phones_and_dates(spark):
    """A phone is replaced whole and alike in every notation, a date also before a time."""
    same = ["415 555 2671", "+14155552671", "4155552671", "(415) 555-2671", "(415)555 2671", "1 415.555.2671", "+1 (415) 555-2671", "415-5552671"]
    low = ["+1 (017) 555-7713", "(017) 555-7713"]
    texts = same + low + ["2020-01-02T10:00:00Z", "2020-01-02", "+1 555 7713", "555-7713", "555 7713", "5557713", "017 555 7713", "2020-01-02Texas"]
    df = spark.createDataFrame([(i, f"x {t}, y") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {texts[x.doc_id]: (x.text[2:-3], x.kinds) for x in pii.pseudonymise(df, "key").collect()}
    national = lambda t: re.sub(r"\D", "", got[t][0])[-10:]
    for group, clear in ((same, "4155552671"), (low, "0175557713")):
        assert len({national(t) for t in group}) == 1 and national(group[0]) != clear
    assert all(got[t][1] == ["phone"] and re.sub("[0-9]", "0", got[t][0]) == re.sub("[0-9]", "0", t) for t in same + low + ["+1 555 7713", "555-7713"])
    assert national(low[0])[0] in "01" and national(same[0])[0] not in "01"
    assert got["2020-01-02T10:00:00Z"] == (got["2020-01-02"][0] + "T10:00:00Z", ["date"]) and got["2020-01-02"][0] != "2020-01-02"
    assert all(got[t] == (t, []) for t in texts[-4:])
    every = spark.range(200 * 8).select(F.concat(F.lit("("), F.lpad(F.floor(F.col("id") / 8).cast("string"), 3, "0"), F.lit(") "), (F.col("id") % 8 + 200).cast("string"), F.lit("-0000")).alias("m"))
    assert every.select(pii.phone(F.col("m"), F.lit("k")).alias("p")).where(r"p RLIKE '^\\([01][0-9]{2}\\) [2-9][0-9]{2}-[0-9]{4}$'").distinct().count() == 1600


def test_pii_permutes(spark):
    """Small domains are mapped one to one: all exchanges of one line, all days."""
    d = spark.range(17 * 4297).select(pii.feistel(F.floor(F.col("id") / 4297), F.col("id") % 4297, F.lit(17), F.lit(4297), F.lit("k"), "date").alias("s"))
    assert d.select("s.a", "s.b").distinct().count() == 17 * 4297 == pii.DAYS and d.where("s.a >= 17 OR s.b >= 4297").count() == 0
    m = spark.range(26 * 26).select(F.concat(F.chr(F.lit(97) + F.floor(F.col("id") / 26).cast("int")), F.chr(F.lit(97) + (F.col("id") % 26).cast("int")), F.lit("@x.org")).alias("m"))
    assert m.select(pii.email(F.col("m"), F.lit("k"))).distinct().count() == 26 * 26


def test_pii_is_native(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    for out in (pii.pseudonymise(df, "k"), exact.exact_dedup(df)):
        assert "Python" not in out._jdf.queryExecution().toString() and "Cartesian" not in out._jdf.queryExecution().toString()


def test_language(spark):
    r, rows, pages = random.Random(5), [], []
    voc = {"en": "the of and with water".split(), "de": "der und nicht wasser zeit".split(), "fr": "le des eau avec temps".split()}
    for i in range(150):
        lang = list(voc)[i % 3]
        rows.append((i, lang, " ".join(r.choices(voc[lang], k=30))))
        pages.append((i, f"http://{lang}{i % 2}.example.{lang if lang != 'en' else 'com'}/p", f"<html lang='{lang if i % 10 else 'fr'}'><p>{' '.join(r.choices(voc[lang], k=12))}</p></html>", "x"))
    pages += [(900, "http://de1.example.de/q", "<html><script>the of and</script></html>", "x"), (901, None, None, "x"), (902, "nonsense", "", "x"), (902, "nonsense", "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    pg = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    got = [(x.page_id, x.lang, x.score) for x in language.identify(pg, docs).collect()]
    assert len(got) == len(pages) and all(lang == list(voc)[i % 3] for i, lang, _ in got if i < 150)
    assert dict((i, lang) for i, lang, _ in got)[900] == "de" and all(0 < s <= 1 for _, _, s in got)
    none = language.identify(pg, docs.limit(0)).collect()
    assert len(none) == len(pages) and {x.lang for x in none} == {None}
    assert language.identify(pg.limit(0), docs).count() == 0


def test_language_posterior_equals_plain_numpy(spark):
    r, rows, pages = random.Random(9), [], []
    voc = {"en": "the of and with water".split(), "de": "der und nicht wasser zeit".split(), "fr": "le des eau avec temps".split()}
    for i in range(90):
        lang = list(voc)[i % 3]
        rows.append((i, lang, " ".join(r.choices(voc[lang], k=30))))
        declared = r.choice(["", f" lang='{lang}'", " lang='fr'"])
        pages.append((i, f"http://{r.choice('abc')}.site{i % 7}.{r.choice(['de', 'com', 'fr'])}/p", f"<html{declared}><p>{' '.join(r.choices(voc[lang], k=i % 3))}</p></html>"))
    pages += [(90, None, None), (91, "nonsense", "")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    pg = spark.createDataFrame(pages, "page_id long, url string, html string")
    names, logs = language.fit_text(docs)
    seen = language.text_posteriors(pg, (names, logs), "page_id", "url", "html").collect()
    whole = 1 + sum(np.array(x.p) for x in seen)

    def count(**by):
        return sum((np.array(x.p) for x in seen if all(x[k] == v for k, v in by.items())), np.zeros(len(names)))

    def prior(counts, own, towards, strength):
        rest = np.maximum(counts - own, 0)
        return (rest + strength * towards) / (rest.sum() + strength)

    def given(column, value):
        c = count(**{column: value})
        return (c + language.CONDITIONAL * c.sum() / whole.sum()) / (whole + language.CONDITIONAL)
    got = {x.page_id: x for x in language.identify(pg, docs).collect()}
    assert len(seen) == len(got) == len(pages)
    for x in seen:
        own = np.array(x.p)
        domain = prior(count(domain=x.domain), own, whole / whole.sum(), language.DOMAIN)
        host = prior(count(host=x.host), own, domain, language.HOST)
        post = np.array(x.ll) + np.log(host) + np.log(given("declared", x.declared)) + .5 * np.log(given("suffix", x.suffix))
        share = np.exp(post - post.max())
        assert abs(got[x.page_id].score - 1 / share.sum()) < 1e-9
        assert got[x.page_id].lang == names[int(post.argmax())] or np.sort(post)[-1] - np.sort(post)[-2] < 1e-9


def test_language_keeps_every_label(spark):
    """140 labels, the rarest the last by name: each has a model and gets its pages."""
    names = [f"l{i:03d}" for i in range(140)]
    r = random.Random(9)
    voc = {n: ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(6)] for n in names}
    rows = [(i * 10 + k, n, " ".join(r.choices(voc[n], k=30))) for i, n in enumerate(names) for k in range(1 if n == names[-1] else 2)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    languages, logs = language.fit_text(docs)
    assert languages == names and logs.shape == (140, language.TRIGRAMS)
    pages = [(i, f"http://h{i}.example.org/", f"<p>{' '.join(r.choices(voc[names[i]], k=30))}</p>") for i in (0, 57, 128, 138, 139)]
    got = {x.page_id: x.lang for x in language.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()}
    assert got == {i: names[i] for i, _, _ in pages}


def planted(n, seed=9):
    """Labelled texts: toxic ones hold some insults among plain words, poor ones are chopped junk."""
    r = random.Random(seed)
    plain = ["".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(600)]
    insults = ["zgrakh" + "".join(r.choice("aeiou") for _ in range(2)) for _ in range(12)]
    docs, labels = [], []
    for i in range(n):
        toxic, good = r.random() < 0.4, r.random() < 0.5
        ws = [r.choice(plain) for _ in range(r.randint(30, 160))]
        if toxic:
            for _ in range(r.randint(3, 6)):
                ws.insert(r.randrange(len(ws)), r.choice(insults))
        text = " ".join(ws) + "." if good else " | ".join(w.upper() + str(r.randrange(99)) for w in ws)
        docs.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_on_held_out_rows(spark, module, label):
    docs, labels = planted(2400)
    got = module.classify(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    y = {i: (q, t)[label == "toxic"] for i, q, t in labels}
    rows = [x for x in got.collect() if x.held_out]
    assert len(rows) > 600 and all(zlib.crc32(str(x.doc_id).encode()) % 3 == 1 for x in rows)
    for k in (0, 1):  # both classes, so that guessing the larger one fails
        own = [x.predicted == k for x in rows if y[x.doc_id] == k]
        assert sum(own) / len(own) >= 0.9


def test_votes_against_plain_numpy():
    """Every score is the similarity-weighted vote of the nearest sample rows, written out row by row."""
    g = np.random.default_rng(1)
    x = g.random((40, quality.TERMS)).astype(np.float32) * (g.random((40, quality.TERMS)) < 0.02)
    z = quality.unit(g.normal(size=(90, 6)).astype(np.float32))
    y = (g.random(90) < 0.5).astype(np.float32)
    model = {"idf": g.random(quality.TERMS).astype(np.float32) + 1, "v": g.normal(size=(quality.TERMS, 6)).astype(np.float32), "z": z, "y": y,
             "w": np.where(y > 0, 0.7, 1.2).astype(np.float32), "prior": 0.3}
    x[7] = 0  # nothing known: the prior
    got = quality.vote(x, model)
    for i, row in enumerate(x):
        q = (row * model["idf"]) @ model["v"]
        q = q / np.linalg.norm(q) if np.linalg.norm(q) else q
        near = sorted(range(90), key=lambda j: -float(q @ z[j]))[:quality.NEIGHBOURS]
        w = [max(float(q @ z[j]), 0.0) ** quality.SHARPNESS * model["w"][j] for j in near]
        want = sum(a * y[j] for a, j in zip(w, near)) / sum(w) if sum(w) else 0.3
        assert abs(got[i] - want) < 1e-4


def test_windows_against_one_by_one(spark):
    """A text's toxicity is the highest score of its windows, each run through the network alone."""
    net = toxicity.Network(5)
    texts = [" ".join(f"{c}{i % 7}" for i in range(n)) for c, n in (("a", 3), ("b", toxicity.WINDOW), ("c", 2 * toxicity.WINDOW + 5), ("d", 400), ("e", 0))]
    got = {x.text: x.score for x in toxicity.score(spark.createDataFrame([(t, 1.0) for t in texts], "text string, score double"), net.p).collect()}
    for t in texts:
        ws = toxicity.split(t)
        first, size, _ = toxicity.windows(np.array([0, len(ws)]))
        assert not len(ws) or (set(np.concatenate([np.arange(a, a + n) for a, n in zip(first, size)])) == set(range(len(ws))))
        best = 0.0
        for a, n in zip(first, size):
            gates = net.gates(toxicity.describe(ws[a:a + n]))
            best = max(best, float(net.score(gates, np.arange(n), np.array([0]), np.array([n]))[0]))
        assert abs(got[t] - best) < 1e-5


def test_classifiers_on_odd_rows(docs, empty, labels):
    for f, module in ((quality.classify, quality), (toxicity.classify, toxicity)):
        out = f(docs, labels).collect()
        assert len(out) == len(odd_rows()) and all(0 <= x.score <= 1 for x in out)
        assert f(empty, labels).count() == 0
        assert {x.score for x in f(docs, labels.limit(0)).collect()} == {0.5}


def test_gradient(monkeypatch):
    """The numpy backward pass against finite differences."""
    net = toxicity.Network(3)
    monkeypatch.setattr(toxicity, "DROPPED", 0.0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rows = toxicity.describe([b"one", b"two", b"threes", b"four"])
    index, mask, y = np.array([[0, 1, 2], [3, 1, 0]]), np.array([[1, 1, 1], [1, 1, 0]], bool), np.array([1.0, 0.0])

    def loss():
        x = net.inputs(rows)
        gates = np.concatenate([x @ net.p["W"][d] + net.p["b"][d] for d in (0, 1)], 1)
        p = net.pool(net.read(gates, index, mask).astype(np.float64), mask)[0]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    before = {k: v.copy() for k, v in net.p.items()}
    net.learn(rows, index, mask, y)
    grads = {k: net.m[k][0] / 0.1 for k in before}
    net.p = before
    for k, at in (("U", (0, 1, 2)), ("U", (1, 3, 20)), ("W", (0, 2, 5)), ("v", (3,)), ("w", (9,)), ("b", (1, 10)), ("word", (rows[1, 0], 2)), ("gram", (rows[2, 3], 1))):
        old = net.p[k][at]
        net.p[k][at] = old + 1e-2
        up = loss()
        net.p[k][at] = old - 1e-2
        down = loss()
        net.p[k][at] = old
        assert abs((up - down) / 2e-2 - grads[k][at]) < 1e-3 + 0.02 * abs(grads[k][at])


def test_empty_tables(spark, empty, labels):
    assert exact.exact_dedup(empty).count() == simhash.near_duplicates(empty).count() == suffixes.remove_repeats(empty).count() == 0
    assert mixing.mix(empty).count() == mixing.mixed_rows(empty).count() == packing.pack_documents(empty, TOKENIZER).count() == 0
    assert pii.pseudonymise(empty, "k").count() == 0
    assert embedding.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_near_copies_with_repeated_ids(spark):
    """Of two texts with one id only the one that is linked with a smaller id goes."""
    r = random.Random(3)
    base = words(r, 400)
    near = next(t for t in (base + f" end{i}" for i in range(2000)) if 0 < (simhash.fingerprint(t) ^ simhash.fingerprint(base)).bit_count() <= 2)
    rows = [(1, base), (3, near), (3, words(r, 50)), (5, base.upper()), (5, words(r, 60)), (7, words(r, 70))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, corpus_pipeline.drop_near_copies(spark, docs, SMALL).collect()))
    assert got == sorted([rows[0], rows[2], rows[4], rows[5]])
    groups = {(x.doc_id, x.text_hash): x.component_id for x in simhash.near_duplicates(docs, with_hash=True).collect()}
    assert sorted(groups.values()) == [1, 1, 1, 3, 5, 7]


CLASHES = ["_id", "_hash", "_quality", "score", "row", "_new", "h", "kept", "size", "fp"]


def test_clashing_columns(spark):
    """Every stage and row-wise operator keeps extra columns whatever their names."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    more = docs.select("*", *[F.lit(c).alias(c) for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES:
        plain, out = stage(spark, docs, SMALL), stage(spark, more, SMALL)
        if name != "packing":
            assert out.columns == more.columns
            assert sorted(x.doc_id for x in out.collect()) == sorted(x.doc_id for x in plain.collect())
            assert out.select(*CLASHES).distinct().collect() == [tuple(CLASHES)]
        else:
            assert out.count() == plain.count()
    found = pii.pseudonymise(more, "k")
    assert found.columns == [*more.columns, "kinds", "n_replaced"] and found.select("_new").distinct().collect() == [("_new",)]
    scored = quality.score(more, quality.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet")))
    assert sorted(scored.columns) == sorted(more.columns) and dict(scored.dtypes)["score"] == "double"


def test_pipeline_stages(spark, tmp_path):
    """Each stage against brute force on the stage's own input."""
    text = lambda d: d.select("doc_id", "text", "source").collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(str(tmp_path / str(i)))
        nxt = spark.read.parquet(str(tmp_path / str(i)))
        before = text(docs)
        if name != "packing":
            assert nxt.columns == docs.columns
            after = text(nxt)
            kept[name] = (len(before), len(after))
        if name == "quality classifier":
            y = {x.doc_id: x.quality for x in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
            clean = [x.doc_id for x in before if y.get(x.doc_id) == 1]
            assert len({x.doc_id for x in after} & set(clean)) >= 0.97 * len(clean)
        elif name == "exact dedup":
            assert sorted(x.doc_id for x in after) == sorted({norm(x.text): x.doc_id for x in sorted(before, key=lambda x: -x.doc_id)}.values())
        elif name == "SimHash near-dedup":
            f = np.array([brute_fingerprint(x.text) for x in before], np.uint64)
            label = join_labels(len(f), *np.nonzero(np.bitwise_count(f[:, None] ^ f) <= 2))
            assert sorted(x.doc_id for x in after) == sorted(min(before[j].doc_id for j in np.flatnonzero(label == c)) for c in set(label.tolist()))
        elif name == "mixing":
            want = sum(x.taken for x in mixing.mix(docs).collect())
            assert sum(len(x.text.split()) for x in after) == want
        else:
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(TOKENIZER)
            assert nxt.agg(F.sum("length")).first()[0] == sum(len(tok.encode(x.text, add_special_tokens=False).ids) + 1 for x in before)
        docs = nxt
    assert corpus_pipeline.run(spark, SMALL).count() > 0
