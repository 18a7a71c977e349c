"""Vector codes, hard negatives and secret scans against brute force, with nulls, ties, repeated rows and clashing columns."""

import collections
import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from covoxel.llm import codes, negatives, secret_scan, vectors
from covoxel.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, score string, h string, block string, n string"
NAN, INF = float("nan"), float("inf")


def rows_of(rng, n, dims=64, labels=4):
    base = [[rng.gauss(0, 0.125) for _ in range(dims)] for _ in range(max(1, n // 3))]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.02))) for x in rng.choice(base)], rng.randrange(labels)) for i in range(n)]
    rows += [(n + 1, None, 1), (n + 2, [None] + [0.5] * (dims - 1), 1), (n + 3, [NAN] + [0.5] * (dims - 1), 1), (n + 4, [INF] * dims, 2), (n + 5, [0.0] * dims, None), (None, [0.25] * dims, 1), (n + 6, list(rows[0][1]), rows[0][2])]
    rows += [rows[7], rows[8], (7, [0.125] * dims, 3), (n + 7, [-0.3] * dims, None)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], VECTORS)


def fine(x):
    return x is not None and all(v is not None and math.isfinite(v) for v in x)


def whole(x):
    return [math.floor(256 * v) for v in x]


def naive_codes(rows, parts, entries, rounds):
    kept = sorted(((i, whole(x), label) for i, x, label in rows if fine(x)), key=lambda r: (r[0] is None, r[0], r[1]))
    w = max(1, -(-len(kept[0][1]) // parts))
    cut = lambda x: [(x + [0] * (parts * w))[p * w : (p + 1) * w] for p in range(parts)]
    cuts = [cut(x) for _, x, _ in kept]
    books = [[cuts[e][p] for e in range(min(entries, len(cuts)))] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min(range(len(book)), key=lambda e: (far(x, book[e]), e))
    for _ in range(rounds):
        for p in range(parts):
            of = collections.defaultdict(list)
            for c in cuts:
                of[near(c[p], books[p])].append(c[p])
            books[p] = [[math.floor(sum(v) / len(of[e])) if e in of else old for v, old in (zip(zip(*of[e]), books[p][e]) if e in of else ((None, o) for o in books[p][e]))] for e in range(len(books[p]))]
    out, labels = [], collections.Counter()
    for (i, _, label), c in zip(kept, cuts):
        best = [near(c[p], books[p]) for p in range(parts)]
        error = sum(far(c[p], books[p][b]) for p, b in enumerate(best))
        out.append((i, "".join(f"{b:02x}" for b in best), error, label))
        labels[label] += error
    digest = hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()
    return sorted(((i, code, error, labels[label], digest) for i, code, error, label in out), key=str)


@pytest.mark.parametrize(("n", "dims", "parts", "entries"), [(150, 64, 16, 64), (40, 10, 4, 64), (30, 3, 16, 8)])
def test_codes_match_brute_force(spark, n, dims, parts, entries):
    rows = rows_of(random.Random(n), n, dims)
    out, books = codes.vector_codes(frame(spark, rows).repartition(5), parts=parts, entries=entries, block_rows=17)
    got = sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect()), key=str)
    assert got == naive_codes(rows, parts, entries, 2)
    assert books[dims].shape == (parts, min(entries, sum(fine(r[1]) for r in rows)), max(1, -(-dims // parts)))
    assert np.array_equal(codes.decode(got[0][1], books[dims]) * 256, np.concatenate([b[int(got[0][1][2 * p : 2 * p + 2], 16)] for p, b in enumerate(books[dims])]))


def test_codes_of_unlike_lengths_and_no_rows(spark):
    rows = [(1, [0.5] * 32, 1), (2, [0.25] * 16, 1), (3, [], None), (4, None, 1), (5, [0.5] * 32, 2)]
    out, books = codes.vector_codes(frame(spark, rows))
    assert sorted((r.vec_id, r.code, r.error) for r in out.collect()) == [(i, "00" * 16, 0) for i in (1, 2, 3, 5)] and sorted(books) == [0, 16, 32]
    assert codes.vector_codes(frame(spark, rows).where("vec_id = 4"))[0].collect() == []
    with pytest.raises(Exception, match="64 bits"):
        codes.vector_codes(frame(spark, [(1, [1e9] * 16, 1)]))[0].collect()


def test_ties_go_to_the_lower_entry_and_means_are_rounded_down():
    book = np.array([[0, 0], [2, 0], [2, 0]])
    best, far = codes.assign(np.array([[1, 2, 9], [0, 0, 9]]), book)
    assert best.tolist() == [0, 1, 1] and far.tolist() == [1, 0, 130]
    sums = codes.Sums(book[None]).add(np.array([[-1, -2], [0, 0]]), book[None])
    assert sums.merge(codes.Sums(book[None])).means(book[None])[0].tolist() == [[-2, 0], [2, 0], [2, 0]]


def naive_negatives(rows, anchors, positives=5, negatives=10, low=30, high=90):
    kept = [(i, whole(x), label) for i, x, label in rows if i is not None and label is not None and fine(x)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for k, (a, x, label) in enumerate(kept):
        if not anchors(a):
            continue
        scored = sorted((-dot(x, y), i, other == label) for j, (i, y, other) in enumerate(kept) if j != k and len(y) == len(x))
        for s, p, _ in [t for t in scored if t[2]][:positives]:
            fits = [t for t in scored if not t[2] and low * -s <= 100 * -t[0] <= high * -s]
            out += [(a, p, r + 1, i, -s, -t) for r, (t, i, _) in enumerate(fits[:negatives])]
    return sorted(out)


@pytest.mark.parametrize(("n", "dims", "scale"), [(260, 64, 1), (120, 5, 1), (90, 8, 200)])
def test_negatives_match_brute_force(spark, n, dims, scale, monkeypatch):
    rng = random.Random(n)
    rows = [(i, None if x is None else [None if v is None else v * scale for v in x], label) for i, x, label in rows_of(rng, n, dims)]
    rows += [(1000, [0.0] * dims, 1), (1001, [0.0] * dims, 2), (1002, [0.5] * 3, 1), (1003, [0.4] * 3, 2), (1004, [0.45] * 3, 1), (1010, [], 1), (1011, [], 2)]
    monkeypatch.setattr(negatives, "GROUP_ANCHORS", 9)
    monkeypatch.setattr(negatives, "GROUP_BYTES", 3000)
    monkeypatch.setattr(negatives, "AT_ONCE", 4)
    out = negatives.hard_negatives(frame(spark, rows).repartition(3), F.col("vec_id") % 7 == 0, block_rows=19)
    got = sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in out.collect())
    want = naive_negatives(rows, lambda i: i % 7 == 0)
    assert got == want and len(want) > 50
    few = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 30 == 0, positives=2, negatives=3, low=55, high=70)
    assert sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in few.collect()) == naive_negatives(rows, lambda i: i % 30 == 0, 2, 3, 55, 70)


def test_bounds_hold_and_spare_most_scores():
    rng = np.random.default_rng(3)
    for scale in (3, 30, 3000):
        x, a = (rng.standard_normal((n, 64)) * scale for n in (700, 20))
        x, a = np.floor(x).astype(np.int64).T, np.floor(a).astype(np.int64)
        low, step, cells = negatives.quantise(x)
        assert (low[:, None] + step[:, None] * cells <= x).all() and (x < low[:, None] + step[:, None] * (cells.astype(np.int64) + 1)).all()
        lower, upper = negatives.bounds(a, low, step, cells)
        exact = a @ x
        assert (lower <= exact).all() and (exact <= upper).all()
        tenth = np.sort(lower, axis=1)[:, -10]
        assert (upper >= tenth[:, None]).mean() < 0.1
    for a in (np.array([-(1 << 63), 5]), np.array([], dtype=np.int64), np.array([127, -128]), np.array([1 << 40])):
        assert np.array_equal(vectors.wide(vectors.narrow(a)), a)


def test_negatives_of_no_rows(spark):
    none = frame(spark, [(100, [1.0, 2.0], 1)])
    assert negatives.hard_negatives(none.where("vec_id = 0"), F.col("vec_id") == 1).collect() == []
    assert negatives.hard_negatives(none, F.col("vec_id") == 100).collect() == []
    assert negatives.hard_negatives(none, F.lit(None).cast("boolean")).collect() == []


def naive_base(text):
    out = []
    for k, (kind, pattern, ok) in enumerate([("assign", r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(1)) >= 12), ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18), ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 16)]):
        at = 0
        while m := re.compile(pattern, re.ASCII).search(text, at):
            if ok(m):
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
            at = m.end()
    return [x for *_, x in sorted(out)]


def test_base_spans_match_brute_force(spark, sf, tmp_path):
    rng = random.Random(4)
    pieces = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "paſſword", "toKen", "AKIA", "AKIAAKIA", "=", ":", " ", "  ", '"', "'", "=", "0123456789abcdef", "ABCDEFGH", "abc", "x1/+.-_", "é", "\n", "é😀", "deadbeef"]
    texts = [None, "", "AKIA" + "B" * 13, "AKIA" + "B" * 14, "password: secret: abcdefghijklmnop", "a" * 15, "a" * 16, "password=" + "x" * 12, "secret=" * 4000, *("".join(rng.choice(pieces) for _ in range(rng.randint(1, 60))) for _ in range(400))]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, spans string, found string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op12_secret_scan"](spark, str(tmp_path)).collect()}
    some = 0
    for i, t in enumerate(texts):
        base, r = naive_base(t or ""), got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex"))
        assert [x for x in r.spans.split(",") if x and not x.startswith("literal")] == base
        some += len(base)
    assert some > 300 and len(got) == len(texts)


def found(text):
    return [text[s:e] for s, e, *_ in secret_scan.literals(text)]


S = "hV7kq2Lw9zRt4XbN"


@pytest.mark.parametrize("text", [
    f'db_password = "{S}"', f"DbPassword := `{S}`", f"const char* pwd = '{S}';", f'{{"user": "x", "client_secret": "{S}"}}', f"password: {S}\n", f"export API_TOKEN={S}", f'config["auth_token"] = "{S}"', f"cfg['db']['password'] = '{S}'",
    f'password: str = "{S}"', f'let apiKey: string = "{S}"', f"'secret' => '{S}',", f'connect(host="h", password="{S}")', f"<password>{S}</password>", f'<add key="x" accessKey="{S}"/>', f"Authorization: Bearer {S}", f'headers = {{"Authorization": "Bearer {S}"}}',
    f'k = "{S}"\nclient.password = k', f'A_1 = "{S}"\nb = A_1\nc = b\nsecret_key = c', f'password = os.environ.get("DB_PASSWORD", "{S}")', f'x = f("{S}")\ntoken = x', f"x = 5\nself.passphrase = r'{S}' # no comment", f'password = """{S}"""', f'private_key = ("{S}")', f"--password={S}", f'user="a" token="b" pwd="{S}"',
])
def test_literals_reach_telling_names(text):
    assert found(text) == [S]


def test_joined_literals_are_found_together():
    assert found(f'secret = "{S[:8]}" + "{S[8:]}"') == [S[:8], S[8:]]
    assert found(f'a = "{S}"\npassword = a + "tail"') == [S]
    assert found(f'password = "{S}"\npassword += "b"') == [S]
    assert found(f'secret = ("{S[:8]}" \\\n   "{S[8:]}")') == [S[:8], S[8:]]


@pytest.mark.parametrize("text", [
    f'name = "{S}"', f'password_file = "{S}"', "password = input()", 'password = "${DB_PASSWORD}"', 'token = "your-token-here"', 'secret: "changeme123"', 'api_key = "xxxxxxxxxxxxxxxx"', "The secret: nobody knows it.", "token = None", 'token_url = "https://a.b/c1"', 'secret = "https://a.b/c1/token"', "password: /run/secrets/db_password",
    f'if password == "{S}":', f'if token != "{S}":', 'password = "correct horse battery 9"', 'key = "aaaaaaaaaaaaaaaaaaaaaaaa1"', f'a = "{S}"\na = 5\n', f'a = "{S}"\na = "b"\npassword = a', "", "=", ":::", '"', "token=", 'secret="', "Meet at 12:30: bring a key.", 'greeting: "Good morning, all"',
])
def test_other_literals_are_left_alone(text):
    assert found(text) == []


def test_long_texts_take_linear_time():
    for piece in ("a", "a:", "a=", '="', "='\"", '="\\', "token=", 'x="a"+', "f(", "a=f(", "[=", "]=", '"]=', "<a>", "password: ", 'password="', "a = a + a\n", "ab1.=", '"""=', "\\\n", "AKIA", "deadbeef ", "secret: b\nb = secret\n"):
        text, start = piece * (300_000 // len(piece)), time.process_time()
        secret_scan.spans(text)
        assert time.process_time() - start < 10, piece


def test_the_query_leaves_prose_alone(spark, sf):
    out = QUERIES["op12_secret_scan"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert out.count() == docs.count()
    plain = out.join(docs.where("text not like '%token%'"), "doc_id")
    assert plain.where("n_literal > 0").count() == 0
    assert secret_scan.find_secrets(docs.limit(0)).collect() == []
