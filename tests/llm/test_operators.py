"""Each operator against a plain version on small rows, with nulls, empty and long
texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
from conftest import SMALL  # noqa: F401
from tokenizers import Tokenizer

from compare import assert_same
from starloom.llm import bpe, html, lattice, packing, queries, secrets, substring, toxicity, warc
from starloom.llm.common import release, scratch_paths, stored
from starloom.llm.components import components
from starloom.llm.exact import DigestIndex, exact_duplicates
from starloom.llm.minhash import near_duplicates

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, views, name):
    assert_same(queries.QUERIES[name](spark, SF), views, queries.ORACLE[name])


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {x: top(x) for x in root}
    assert rows_of(components(spark.createDataFrame([], "a long, b long"))) == []


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_by_hand(docs, percent=85):
    ids = [d for d, _ in docs]
    s, root = [shingles(t) for _, t in docs], {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(docs)):
        for j in range(i):
            both = len(s[i] & s[j])
            if s[i] and s[j] and None not in (ids[i], ids[j]) and 100 * both >= percent * (len(s[i] | s[j])):
                x, y = top(ids[i]), top(ids[j])
                root[max(x, y)] = min(x, y)
    return sorted(((d, len(x), None if d is None else top(d)) for d, x in zip(ids, s)), key=str)


def test_near_duplicates_by_brute_force(frame):
    rng, docs = random.Random(1), []
    for base in range(4):  # groups of near copies: some links hold, some are just missed
        words = prose(base, 120).split()
        for _ in range(70 if base == 0 else 12):
            w = list(words)
            for _ in range(rng.choice((0, 1, 1, 2, 3, 4))):
                w[rng.randrange(len(w))] = prose(rng.random(), 1)
            docs.append((len(docs), " ".join(w)))
    docs += [(900, None), (901, ""), (902, " \t\n"), (903, "One TWO three"), (904, "one two\tthree"), (905, prose(9, 30_000)),
             (906, "É one two three four"), (907, "é one two three four"), (None, docs[0][1]), (0, docs[0][1]), (908, docs[3][1].upper())]
    got = sorted(((r[0], r[1], r[2]) for r in rows_of(near_duplicates(frame(docs)))), key=str)
    assert got == near_by_hand(docs)


def test_large_nodes_take_the_block_way(frame, monkeypatch):
    import starloom.llm.minhash as m
    monkeypatch.setattr(m, "SMALL", 3)
    monkeypatch.setattr(m, "BLOCK", 2000)
    rng, docs, words = random.Random(2), [], prose(77, 100).split()
    for i in range(60):
        w = list(words)
        for _ in range(rng.choice((1, 2, 3))):
            w[rng.randrange(len(w))] = prose(rng.random(), 1)
        docs.append((i, " ".join(w)))
    got = sorted(((r[0], r[1], r[2]) for r in rows_of(near_duplicates(frame(docs)))), key=str)
    assert got == near_by_hand(docs)


def test_vectors_by_brute_force(frame):
    rng = np.random.default_rng(5)
    x = []
    for k in range(6):
        base = rng.normal(size=24)
        x += [base + rng.normal(size=24) * s for s in rng.choice((0.02, 0.1, 0.2, 0.25), 60 if k == 0 else 8)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    rows += [(500, None), (501, []), (502, [0.0] * 24), (503, [float("nan")] * 24), (504, [None] + [1.0] * 23), (505, [float("inf")] * 24),
             (506, rows[0][1]), (507, [c * 4 for c in rows[0][1]]), (508, rows[0][1][:12]), (509, [c * 1e-30 for c in rows[1][1]]), (None, rows[0][1])]
    got = {r[0]: r[1:] for r in rows_of(lattice.near_vectors(frame(rows, ("vec_id", "embedding"), ("long", "array<float>"))))}
    ok = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    ok = {i: v / np.linalg.norm(v) for i, v in ok.items()}
    links = {i: [j for j in ok if j != i and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= 0.95] for i in ok}
    for i, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        low = None if i is None else min(seen)
        assert got[i] == (len(links.get(i, [])), low, low == i), i


def test_lattice_decodes_to_the_nearest_point():
    x = np.random.default_rng(1).normal(size=(500, 8)) * 2
    p = lattice.decode(x)
    assert ((2 * p) % 1 == 0).all() and (p.sum(1) % 2 == 0).all() and len(lattice.SHORTEST) == 240
    d = ((x - p) ** 2).sum(1)
    assert all((((x - p - v) ** 2).sum(1) >= d - 1e-9).all() for v in lattice.SHORTEST)


def secrets_by_hand(t):
    out = [("assign", m.start(), m.end()) for m in re.finditer(secrets.ASSIGN.pattern, t, re.I | re.A) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.KINDS.index(s[0])))


def test_secrets(frame):
    token, digest = "xQ9vT2mZk7LpR4wNf8Js1YbH6gDc3AeU", hashlib.sha256(b"a").hexdigest()
    texts = [None, "", "password=abc", "PassWord : 'abcdef' secret=token:abcdefgh", "api_key=\"" + "a1" * 20 + "\" AKIA" + "Z9" * 9, "AKIAAKIA", "ſecret=abcdefg",
             f"é 😀 {token} {digest} {digest[:23]} 550e8400-e29b-41d4-a716-446655440000", "someVeryLongIdentifierName some_long_snake_case_name 12345678901234567890",
             "a" * 200_000 + " token=" + "f" * 30]
    docs = list(enumerate(texts)) + [(None, texts[4]), (4, texts[4])]
    got = rows_of(secrets.digests(secrets.scan(frame(docs))))
    for (i, t), r in zip(sorted(docs, key=str), sorted(got, key=str)):
        base = secrets_by_hand(t or "")
        count = [sum(k == x for x, _, _ in base) for k in ("assign", "access", "hex")]
        assert (r[0], *r[1:4]) == (i, *count)
        assert r[4] == hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in base).encode()).hexdigest()
    assert [s for s in secrets.spans(texts[7]) if s[0] == "random"] == [("random", 4, 4 + len(token))]
    assert not secrets.spans(texts[8])
    red = {r.doc_id: r.text for r in secrets.redact(frame(list(enumerate(texts)))).collect()}
    assert red[0] is None and red[2] == texts[2] and token not in red[7] and digest not in red[7] and red[8] == texts[8]


def test_secrets_of_one_case(frame):
    rng = random.Random(12)
    bad = ["".join(rng.choices(abc, k=32)) for abc in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(200)]
    found = [secrets.spans(f"key {t} end") for t in bad]
    assert sum(f == [("random", 4, 36)] for f in found) >= 0.95 * len(bad)
    keys = ["QWXZ-KPLM-VBNT-RTYU-HJKD", "xkqz7281-vjwp3390-fhgt1102"]
    assert [secrets.spans(t) for t in keys] == [[("random", 0, len(t))] for t in keys]
    assert [r.text for r in secrets.redact(frame(list(enumerate(keys)))).collect()] == ["[SECRET]"] * 2
    for t in ("some-very-long-identifier-name2024", "MAX_NUMBER_OF_CONNECTIONS", "internationalization_settings", "2024-01-02-03-04-05-06-07",
              "someVeryLongIdentifierName", "550e8400-e29b-41d4-a716-446655440000", "-" * 40):
        assert not secrets.spans(t)
    began = time.process_time()
    secrets.spans("A" * 40 + "12345 " + "Ab" * 5_000 + "12345")  # words with nested repeats take years
    assert time.process_time() - began < 5


@pytest.mark.parametrize("chunk,overlap", [(32_768, 512), (37, 20)])
def test_bpe_equals_tiktoken(frame, chunk, overlap):
    texts = [None, "", " ", "\n\n  a  b\n\n\nc", "don't we'll I'M 'tis", "x" * 300, " " * 200 + "y", "日本語のテキスト" * 30, "é́ 😀😀 \u00a0\u2003 z 12 345", "<|endoftext|> ok",
             prose(4, 400), "\r\n" * 60 + "end", "  " + prose(5, 90) + "   \n  " + prose(6, 90)]
    docs = list(enumerate(texts)) + [(None, texts[10]), (10, texts[10])]
    enc = bpe.encoding(bpe.RANKS)
    got = sorted(rows_of(bpe.digests(bpe.decode(bpe.encode(frame(docs), chunk=chunk, overlap=overlap)))), key=str)
    want = []
    for i, t in docs:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def encoded_by_match(ranks, text):
    """Match by match, each by merging the pair of the lowest rank; equal matches once."""
    def piece(b):
        parts = [b[i:i + 1] for i in range(len(b))]
        while len(parts) > 1:
            low, i = min((ranks.get(x + y, 1 << 30), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
            if low == 1 << 30:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]
    return [i for m in regex.finditer(public_tokenizers.PATTERN, text) for i in piece(m[0].encode())]


@pytest.mark.parametrize("tail", ["", "b", " b", "\n", "é 12"])
def test_bpe_around_white_space(monkeypatch, tail):
    """The way round the library's pattern gives what the pattern gives."""
    enc = bpe.encoding(bpe.RANKS)
    monkeypatch.setattr(bpe, "BLANKS", regex.compile(r"\s{4,}"))
    for blank in (" ", "\t", "\n", "\r\n", " \n", "\u3000", "\u00a0 ", "\x1c "):
        for n in (2, 3, 4, 5, 8, 30):
            text = "a" + blank * n + "'s" + blank * n + "x" + blank * n + tail
            assert bpe.ids_of(enc, text) == enc.encode_ordinary(text) == encoded_by_match(enc._mergeable_ranks, text)


def test_bpe_of_a_million_blanks(frame):
    enc = bpe.encoding(bpe.RANKS)
    texts = ["a" + blank * 1_200_000 + "b" for blank in (" ", "\t", "\n", "\r\n")]
    got = {r["doc_id"]: (r["ids"], bytes(r["bytes"])) for r in bpe.decode(bpe.encode(frame(list(enumerate(texts))))).collect()}
    for i, t in enumerate(texts):
        want = enc.encode_ordinary("a") + enc._encode_single_piece(t[1:-2]) + enc.encode_ordinary(t[-2:])
        assert got[i] == (want, t.encode())


def removed_by_hand(docs, span=50):
    first = {}
    words = [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in words:
        if d is not None:
            for i in range(len(w) - span + 1):
                k = tuple(w[i:i + span])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = {p for i in range(len(w) - span + 1) if d is not None and first[tuple(w[i:i + span])] < d for p in range(i, i + span)}
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for p, x in enumerate(w) if p not in gone)).hexdigest()))
    return sorted(out, key=str)


def test_substrings_by_brute_force(frame):
    p = [prose(i, n) for i, n in enumerate((60, 50, 49, 130, 400, 75))]
    line = prose(50, 11)
    docs = [(1, prose(20, 30) + " " + p[0] + " " + prose(21, 40)), (2, p[0] + "\n\t" + prose(22, 20)), (3, prose(23, 9) + " " + p[1]), (4, p[1]), (5, p[2] + " " + prose(24, 80)),
            (6, prose(25, 80) + " " + p[2]), (7, p[4]), (8, p[4][:900] + " zz " + p[4][900:]), (9, p[4]), (10, p[4] + " " + p[3]), (11, p[3] + " " + p[4]), (12, None), (13, ""),
            (14, " \n"), (15, " ".join([line] * 40)), (16, prose(26, 5) + " " + " ".join([line] * 90)), (17, "a " * 200), (18, "a " * 130), (None, p[4]), (7, p[4]),
            (7, p[5] + " " + p[0]), (20, p[5] + " " + p[0].upper())]
    docs += [(100 + i, prose(100 + i, 10) + " " + p[3] + " " + prose(200 + i, 10)) for i in range(20)]
    assert sorted(rows_of(substring.digests(substring.remove_repeats(frame(docs)))), key=str) == removed_by_hand(docs)


def test_packing(frame):
    texts = [None, "", "Σας ΣΑΣ don't 12345 漢字", "ȺB, İstanbul. x., .. a.. É. 5.", prose(1, 9000), "hello <|endoftext|>", "<|ENDOFTEXT|> <|endoftext|>",
             "a<|startoftext|>B, <|endoftext|>. É<|endoftext|>é <|StartOfText|>x,", "<|endoftext|><|endoftext|>,\n<| endoftext |>"] + [prose(i, 10 + 7 * i % 300) for i in range(120)]
    docs = list(enumerate(texts)) + [(None, texts[4])]
    got = rows_of(packing.pack(frame(docs).coalesce(1)))
    model = Tokenizer.from_file(packing.TOKENIZER)  # as the library reads it, without the operator
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r)
    for i, t in docs:
        ids = np.array(model.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for _, start, n, crc, total, _, _ in sorted(by[i], key=lambda r: r[1]):
            assert (start, crc, total) == (at, zlib.crc32(ids[at:at + n].tobytes()), len(ids))
            at += n
        assert at == len(ids)
    fill = {}
    for *_, n, _, _, seq, off in sorted(((r[0] or -1, r[1], r[2], r[3], r[4], r[5], r[6]) for r in got), key=lambda r: (r[5], r[6])):
        assert fill.get(seq, 0) == off
        fill[seq] = off + n
    assert max(fill.values()) <= 2048 and sum(fill.values()) / (2048 * len(fill)) > 0.9


def test_differencing_balances():
    x = np.random.default_rng(2).integers(1, 512, 600)
    sums = np.bincount(packing.differencing(x, 40), x, 40)
    assert sums.sum() == x.sum() and sums.max() - sums.min() < 30


def toxic_set():
    rng, docs, labels = random.Random(8), [], []
    for i in range(900):
        w = prose(i, 40).split()
        if bad := i % 5 == 0:
            for x in rng.sample(("idiot", "moron", "stupid", "scum"), 2):
                w.insert(rng.randrange(len(w)), x)
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity(spark, frame):
    docs, labels = toxic_set()
    tail = [(5000, None), (5001, ""), (None, docs[0][1]), (5002, "what a stuupid thing"), (5003, "such an id-iot moron here"), (5004, "i d i o t s t u p i d")]
    lab = spark.createDataFrame(labels + [(None, 1), (1, None), (77_777, 1)], "doc_id long, toxic int")
    model = toxicity.fit(frame(docs), lab)
    got = {r[0]: r for r in rows_of(toxicity.score(frame(docs + tail), model))}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i][1] == (i in set(held)) for i, _ in labels) and got[None][1] is None
    assert sum(got[i][3] == y for i, y in labels if i in set(held)) >= 0.95 * len(held)
    assert all(0 <= r[2] <= 1 for r in got.values()) and got[5000][2] == got[5001][2] and got[5000][3] == 0
    assert got[5003][3] == 1 and got[5002][2] > got[5001][2]
    kept = toxicity.harmless(frame(docs), model)
    assert kept.columns == frame(docs).columns and {r.doc_id for r in kept.collect()} == {i for i, _ in docs if not got[i][3]}
    # held-out labels make no difference
    other = spark.createDataFrame([(i, 1 - y if i in set(held) else y) for i, y in labels], "doc_id long, toxic int")
    assert toxicity.fit(frame(docs), other).slopes == pytest.approx(model.slopes, rel=1e-3)
    assert {r[3] for r in rows_of(toxicity.judge(frame(docs[:9]), lab.limit(0)))} == {0}


def test_exact_index(spark, frame):
    one = [(3, "a b"), (1, "ab"), (2, "a  b "), (4, None), (5, ""), (6, " \n"), (7, "É"), (None, "ab"), (8, "x" * 100_000), (8, "x" * 100_000)]
    got = {(r[0], r[4][:4]): r[1:4] for r in rows_of(exact_duplicates(frame(one)))}
    assert {k[0]: v for k, v in got.items()} == {3: (2, 4, False), 1: (2, 4, False), 2: (2, 4, True), 4: (6, 3, False), 5: (6, 3, False), 6: (6, 3, True), 7: (7, 1, True),
                                                 None: (2, 4, False), 8: (8, 2, True)}
    index = DigestIndex(spark, "test_digests", 4)
    spark.sql("DROP TABLE IF EXISTS test_digests")
    index.absorb(frame(one)).count()
    later = {r[0]: r[1:4] for r in rows_of(index.absorb(frame([(20, "a b"), (21, "new"), (22, "n ew")])))}
    assert later == {20: (2, 1, False), 21: (22, 2, False), 22: (22, 2, True)}
    assert index.read().count() == 5
    spark.sql("DROP TABLE test_digests")


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_exact_over_batches_by_brute_force(frame, batches):
    """Best row and group size hold over all batches, whichever of them a copy is in."""
    rng = random.Random(batches)
    docs = [(i, rng.choice(("a", "b c", "", None)) if i % 3 == 0 else " " * rng.randrange(4) + f"t{rng.randrange(60)}" + "\n" * rng.randrange(3)) for i in range(300)]
    docs += [(5, docs[5][1]), (None, docs[7][1]), (None, "only here")]
    groups = {}
    for d, t in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0, d))
    want = []
    for d, t in docs:
        bare = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[bare])[3]  # a null id comes last among texts of one length
        want.append((d, keep, len(groups[bare]), d == keep, hashlib.sha256(bare.encode()).hexdigest()))
    assert sorted(rows_of(exact_duplicates(frame(docs), batches=batches)), key=str) == sorted(want, key=str)


def test_exact_anti_join_reads_a_filled_index_in_its_buckets(spark, frame, monkeypatch):
    import contextlib
    import io
    plans, real = [], DigestIndex.unknown

    def seen(self, groups):
        out = real(self, groups)
        with contextlib.redirect_stdout(buf := io.StringIO()):
            out.explain("simple")
        plans.append((self.spark.table(self.name).count(), buf.getvalue()))
        return out
    monkeypatch.setattr(DigestIndex, "unknown", seen)
    exact_duplicates(frame([(i, f"t{i % 40}") for i in range(200)]), batches=3).count()
    assert len(plans) == 2 and plans[0][0] > 0 and plans[1][0] > plans[0][0] - 1
    for _, text in plans:
        join = text[text.index("SortMergeJoin"):]
        assert "LeftAnti" in join and "Bucketed: true" in join and join.count("Exchange") == 1  # the batch's side


def test_warc_rejects_magic_in_payloads(spark, frame):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html_ = ["<p>" + "x" * 200, "<p>" + "x" * 200, "short", "short", None, "", "é" * 60 + fake + "tail" + fake, fake, "WARC/1.0\r\n" * 5, "a\r\n\r\nb" * 50, fake * 40, fake * 40]
    pages = [(i, "http://h/\r\n" if i else None, h) for i, h in enumerate(html_)] + [(None, "u", "q" * 300), (3, "u", "again")]
    df = frame(pages, ("page_id", "url", "html"), ("long", "string", "string"))
    want = []
    for i, _, h in pages:
        b = (h or "").encode()
        low = min((j for j, _, g in pages if j is not None and g == h), default=i)
        again = len(b) >= 100 and i is not None and low != i
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", low if again else None))
    assert sorted(rows_of(warc.page_records(df)), key=str) == sorted(want, key=str)
    # plain files, cut into many small splits
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    from starloom.llm.common import scratch_path
    path = scratch_path(spark, "plain")
    warc.write_archives(df, path, compression="none")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        n = [(r.kind, r.payload_bytes) for r in warc.read_archives(spark, path).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert sorted(n) == sorted((w[3], 0 if w[3] == "revisit" else w[1]) for w in want)


def test_warc_long_urls(frame):
    pages = [(i, "http://h/", f"<p>{i} " + "x" * 200) for i in range(6)] + [(6, "http://h/", "<p>0 " + "x" * 200)]
    pages[2] = (2, "data:text/html," + "é" * 50_000, pages[2][2])
    pages[3] = (3, "http://h/?" + " " * 100_000 + "q", "")
    got = rows_of(warc.page_records(frame(pages, ("page_id", "url", "html"), ("long", "string", "string"))))
    assert sorted(r[:3] for r in got) == [(i, len(h), hashlib.sha256(h.encode()).hexdigest()) for i, _, h in pages]
    assert [r[0] for r in got if r[3] == "revisit"] == [6]


def test_html():
    page = ("<html><head><title>no</title><style>.x, #y {display: none}</style></head><body>Hi <b>the</b>re<p>one<p>two &amp; three<div hidden>no</div><i class='a x'>no</i>"
            "<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul><table><tr><th>Name<th>Age<tr><td>Bo<td>5<tr><td rowspan=2>R<td>1<tr><td>2</table>"
            "<pre>\n  x\n   y</pre><details><summary>S</summary>no</details><script>if (a<b) '</p>'</script><!-- c --> 1 < 2")
    assert html.render(page) == ("Hi there\n\none\n\ntwo & three\n\n- a\n- b\n  3. c\n  4. d\n\nName  Age\nBo    5\nR     1\n      2\n\n  x\n   y\n\nS\n1 < 2")
    assert html.render("") == "" and html.render("<p") == "" and html.render("a<!--") == "a"
    assert html.render("<div>" * 20_000 + "deep") == "deep"


@pytest.mark.parametrize("css,seen", [
    ("@media print { nav, .x { display:none } }", True), ("@media (max-width:600px){.x{display:none}}", True), ("@supports (a:b){@media all{.x{display:none}}}", True),
    (".x{display:none} .x{display:block}", True), (".x{display:none !important} .x{display:block}", False), (".x{visibility:hidden} .x{display:block}", False),
    ("#i{display:block} .x{display:none}", True), ("@import 'a;b'; @media screen, print {.x{color:red;display:none}}", False), ("@font-face{a:b} .x { display : none }", False),
    (".y::after{content:'}'} /* .x{} */ .x{display:none", False), ("@media print{.x{a:b}} .x{display:none}", False), (".x{color:red; .z{display:none}}", True)])
def test_html_style_rules(css, seen):
    assert html.render(f"<style>{css}</style>a <b class=x id=i>b</b>") == ("a b" if seen else "a")


def test_html_style_media_and_inline():
    assert html.render("<style media=print>.x{display:none}</style><style>.y{display:none}</style><b class=x>a</b><b class=y style='display:inline'>b</b><i style='x:y;Display:None'>c</i>") == "ab"
    css = "".join(f".c{i}{{display:none}}" for i in range(3000))
    assert html.render(f"<style>{css}</style><p class=c2999>no<p>yes") == "yes"


@pytest.mark.parametrize("tag", ["form", "div", "center", "caption", "thead", "b"])
def test_html_cells_without_a_row(tag):
    assert html.render(f"<table><{tag}><td>x<td>y</table>z") == "x  y\n\nz"
    assert html.render(f"<table><tr><td>a<table><{tag}><th>x</table><td>b</table>").split() == ["a", "b", "x"]


def test_html_words_equal_a_plain_parser(spark):
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.out, self.off = [], 0

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("head",)
            self.out.append(" " * (tag in html.BLOCK or tag == "br"))

        def handle_endtag(self, tag):
            self.off -= tag in ("head",)
            self.out.append(" " * (tag in html.BLOCK))

        def handle_data(self, data):
            if not self.off:
                self.out.append(data)
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in queries.QUERIES["op10_html_extraction"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    for i, markup in pages.items():
        p = Plain()
        p.feed(markup)
        p.close()
        assert re.sub(r"(?m)^\s*- ", "", got[i]).split() == "".join(p.out).split()


@pytest.mark.parametrize("op", [near_duplicates, lambda d: bpe.decode(bpe.encode(d)), secrets.scan, substring.remove_repeats, packing.pack, exact_duplicates, secrets.redact])
def test_empty_table(frame, op):
    assert rows_of(op(frame([]))) == []


def test_empty_pages_and_vectors(frame):
    assert rows_of(lattice.near_vectors(frame([], ("vec_id", "embedding"), ("long", "array<float>")))) == []
    empty = frame([], ("page_id", "url", "html"), ("long", "string", "string"))
    assert rows_of(warc.page_records(empty)) == [] and rows_of(html.extract(empty)) == []


def test_release_deletes_scratch(spark):
    stored(spark.range(3).toDF("x"), "gone").count()
    assert release(spark, scratch_paths()[-1:]) == 1


def test_near_duplicates_at_other_thresholds(frame):
    from starloom.llm.minhash import _children, bits_apart
    assert (bits_apart(85), bits_apart(80)) == (16, 19)
    keys, sk = np.arange(1, 20_001, dtype=np.uint64), np.zeros((20_000, 64), np.uint32)
    for percent in (85, 80, 40):
        assert len(_children(keys, sk, percent)[0]) == pytest.approx(20_000 * 100 / percent, rel=0.01)
    docs = []
    for base in range(60):  # pairs of 96 shingles each, 86 of them shared: 0.811
        words = prose(1000 + base, 100).split()
        docs.append((2 * base, " ".join(words)))
        words[20 + base % 7], words[60 + base % 9] = "zz", "yy"
        docs.append((2 * base + 1, " ".join(words)))
    for percent in (85, 80):
        got = sorted(((r[0], r[1], r[2]) for r in rows_of(near_duplicates(frame(docs), percent))), key=str)
        assert got == near_by_hand(docs, percent) and sum(d != c for d, _, c in got) == (60 if percent == 80 else 0)


HOSTILE = {
    "fenced end tags": "<table><tr><td><i><table><tr><td>" + "<span>" * 100_000 + "</i>" * 100_000 + "end",
    "open paragraphs": "<b>" * 50_000 + "</p>" * 50_000 + "<p>" * 50_000 + "end", "items": "<li>" * 100_000 + "end", "lists": "<ul>" * 30_000 + "<li>end" * 3000,
    "definitions": "<dl>" + "<dt>a<dd>end" * 50_000, "long spans": "<table>" + "<tr><td rowspan=65534 colspan=1000>end" * 20_000,
    "spans of all lengths": "<table><tr>" + "".join(f"<td rowspan={i + 2}>x" for i in range(20_000)) + "<tr><td>end" * 20_000,
    "descendants": "<style>.a .b{visibility:hidden} .b > .c{display:none}</style><div class=a>" + "<b class=b>no" * 100_000 + "<b style='visibility:visible'>end",
    "wide cells": "<table>" + "<tr><td>" + "x" * 5000 + "<td>y" + "<tr><td>a<td>end" * 20_000}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_html_in_linear_time(name):
    began = time.process_time()
    out = html.render(HOSTILE[name])
    assert "end" in out and time.process_time() - began < 8 and len(out) < 20 * len(HOSTILE[name])


@pytest.mark.parametrize("markup,text", [
    ("<div style='visibility:hidden'>a<b style='visibility:visible'>b</b><i>c</i></div>d", "b\nd"),
    ("<style>i{visibility:hidden} i.x{visibility:inherit}</style><b>a<i>b<i class=x>c</i></i></b>", "a"),
    ("<style>div.x{display:none} .a .b{display:none}</style><div class=x>no</div><b class=x>1</b><div class=a><p><b class=b>no</b>2</div><b class=b>3</b>", "1\n\n2\n\n3"),
    ("<style>ul > li.q{display:none}</style><ul><li class=q>no<li><b><i class=q>a</i></b></ul>", "- a"),
    ("<style>#m .x .y{display:none} .y{display:block!important}</style><p id=m><b class=x><i class=y>a</i></b>", "a"),
    ("<style>.a > .b > .c{display:none}</style><p class=a><b class=b><i class=c>no</i></b><b><i class=c>1</i></b><u><b class=b><i class=c>2</i></b></u>", "12"),
    ("<style>b:hover, b + i, b[x] {display:none} u, b ~ i{display:none}</style><b x>1</b><i>2</i><u>no</u>", "12"),
    ("<style>.x{display:block}</style><p hidden>no<p hidden class=x>a<p style='display:block' hidden>b", "a\n\nb"),
    ("<style>p.x.y{display:none} p.x{display:block}</style><p class='x y'>no<p class=x>a", "a"),
    ("<select><optgroup><option>a<option>b</optgroup><option>c</select>", "a"), ("<select><option>a<optgroup><option selected>b</optgroup></select>", "b"),
    ("<ol><li style='visibility:hidden'>no<li>a</ol>", "2. a"), ("<q style='visibility:hidden'>no</q><q>a</q>", "“a”")])
def test_html_visibility(markup, text):
    assert re.sub(r"\n+", "\n", html.render(markup)) == re.sub(r"\n+", "\n", text)


def test_html_wide_cells_keep_their_columns():
    assert html.render("<table><tr><td>" + "w" * 70 + "<td>x<tr><td>a<td>y</table>") == "w" * 70 + "  x\n" + "a" + " " * 71 + "y"
    assert html.render("<table><tr><td rowspan=2000>r<td>0" + "".join(f"<tr><td>{i}" for i in range(1, 2100)) + "</table>").splitlines()[1998:2002] == \
        ["      1998", "      1999", "2000", "2001"]
    assert html.render("<table><tr><td colspan=2000000000>a<tr><td>b<td colspan='2x'>c<td>d") == "a\nb  c  d"


def placed_by_hand(rows):
    """Columns of the cells, slot by slot; None where spans overlap."""
    taken, out = set(), []
    for r, row in enumerate(rows):
        c, mine = 0, []
        for _, across, down in row:
            while (r, c) in taken:
                c += 1
            mine.append((c, across, down))
            c += across
        for c, across, down in mine:
            new = {(r + i, c + j) for i in range(1, down) for j in range(across)}
            if new & taken:
                return None
            taken |= new
        out.append([c for c, *_ in mine])
    return out


def test_html_spans_by_brute_force():
    rng, checked = random.Random(6), 0
    for _ in range(400):
        rows = [[([f"{r}.{k}"], rng.choice((1, 1, 2, 3)), rng.choice((1, 1, 1, 2, 3, 5))) for k in range(rng.randrange(5))] for r in range(8)]
        free, got = html._Free(), []
        for r, row in enumerate(rows):
            c, mine = 0, []
            for _, across, down in row:
                c = free.first(c)
                mine.append((c, across, down))
                c += across
            free.until(r + 1)
            for c, across, down in mine:
                if down > 1:
                    free.take(c, c + across, r + down - 1)
            got.append([c for c, *_ in mine])
        if (want := placed_by_hand(rows)) is not None:
            assert got == want
            checked += 1
        assert sorted(" ".join(html.table_lines(rows)).split()) == sorted(x[0][0] for row in rows for x in row)
    assert checked > 50


def test_html_nulls_repeats_and_clashing_columns(frame):
    rows = [(1, None), (1, "<p>a"), (None, "<p>b"), (1, "<p>a"), (2, ""), (None, None)]
    got = rows_of(html.extract(frame(rows, ("page_id", "html")).withColumn("text", __import__("pyspark.sql.functions").sql.functions.lit("clash"))))
    assert sorted(got, key=str) == sorted([(1, ""), (1, "a"), (None, "b"), (1, "a"), (2, ""), (None, "")], key=str)


def test_warc_damaged_archives_are_named(spark, frame, tmp_path):
    """A chain that ends before its file does raises; without ``strict`` the records up to there come back."""
    pages = [(i, "u", f"<p>{i}" + "x" * 50) for i in range(6)]
    path = tmp_path / "w"
    warc.write_archives(frame(pages, ("page_id", "url", "html"), ("long", "string", "string")).coalesce(1), str(path), compression="none")
    (file,) = path.glob("part-*")
    whole = file.read_bytes()
    assert warc.read_archives(spark, str(path)).count() == 6

    def put(data):
        for crc in path.glob(".*.crc"):
            crc.unlink()
        file.write_bytes(data)
    third = [m.start() for m in re.finditer(rb"WARC/1\.0", whole)][3]
    for data in (whole[:third] + whole[third:].replace(b"Content-Length", b"Content Length", 1), whole[:-3], whole + b"tail", b"head" + whole):
        put(data)
        with pytest.raises(ValueError, match="no record starts at byte"):
            warc.read_archives(spark, str(path))
        assert warc.read_archives(spark, str(path), strict=False).count() == (0 if data[:4] == b"head" else 3 if data[:-3] != whole[:-6] and len(data) == len(whole) else 6)
    put(b"")
    assert warc.read_archives(spark, str(path)).count() == 0


def test_warc_bitmap_of_files_may_hold_any(spark, frame, monkeypatch):
    """With one bit set for all files nothing changes."""
    monkeypatch.setattr(warc, "FILE_BITS", 15)
    fake = "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    pages = [(i, "u", fake * (i % 3) + f"{i}" + "y" * 120) for i in range(40)]
    df = frame(pages, ("page_id", "url", "html"), ("long", "string", "string")).repartition(5)
    got = {r[0]: r[1:3] for r in rows_of(warc.page_records(df))}
    assert got == {i: (len(h), hashlib.sha256(h.encode()).hexdigest()) for i, _, h in pages}
