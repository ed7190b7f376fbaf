"""Exact, near and substring dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from llm_frames import LONG, frame, none, odd  # noqa: F401

from delaylake.llm import components, exact_dedup, near_dedup, substring_dedup, words
from delaylake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(spark, sf=SF):
    return [(r[0], r[1] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def test_words_equal_regex():
    rows = ["a b", None, "", "  x\t\n y ", "é漢 z\x0bq\x1cr", "one", " "]
    w = words.words_of(pa.array(rows))
    got = [bytes(w.data[a:b]).decode() for a, b in zip(w.start, w.end, strict=True)]
    assert got == [x for t in rows for x in WORD.findall(t or "")]
    assert list(w.counts) == [len(WORD.findall(t or "")) for t in rows]
    assert w.hashes[got.index("x")] != w.hashes[got.index("y")]


def test_rice_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 500):
        values = np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64))
        gaps = np.diff(values)
        shift = exact_dedup.golomb_shift(len(gaps), int(values[-1] - values[0]) if n else 0)
        coded = exact_dedup.rice_encode(gaps, shift)
        assert (exact_dedup.rice_decode(coded, len(gaps), shift) == gaps).all()
        assert n < 500 or len(coded) < 8 * len(values)


def exact_brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def test_exact_query(spark):
    assert sorted(map(tuple, QUERIES["op5_golomb_dedup"](spark, SF).collect()), key=repr) == exact_brute(texts(spark))


@pytest.mark.parametrize("per_owner", [2, 1 << 20])
def test_exact_on_odd_rows(spark, odd, none, per_owner):
    out = exact_dedup.exact_duplicates(odd.repartition(3), per_owner=per_owner)
    assert sorted(map(tuple, out.collect()), key=repr) == exact_brute([(r.doc_id, r.text) for r in odd.collect()])
    assert exact_dedup.exact_duplicates(none).count() == 0


def near_brute(rows, n, percent=80):
    sets = {}
    for i, t in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for a, x in enumerate(ids):
        for y in ids[a + 1 :]:
            if 100 * min(len(sets[x]), len(sets[y])) >= percent * max(len(sets[x]), len(sets[y])):
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    p, q = find(x), find(y)
                    root[max(p, q)] = min(p, q)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in sets)


def test_near_query(spark):
    assert sorted(map(tuple, QUERIES["op8_fast_sketch_dedup"](spark, SF).collect())) == near_brute(texts(spark), 2)


def test_near_group_with_strays(spark, monkeypatch):
    """A group larger than a block bound, with members at every distance, some linked to none or through others only."""
    monkeypatch.setattr(near_dedup, "BLOCK_LEAST", 4)
    rng = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(90):
        w = list(base)
        for k in rng.sample(range(120), rng.choice([1, 2, 4, 6, 8, 9, 10, 14])):
            w[k] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w), "en", "s"))
    got = near_dedup.near_duplicates(frame(spark, rows), shingle=2)
    assert sorted(map(tuple, got.collect())) == near_brute([(r[0], r[1]) for r in rows], 2)


def thue_morse(turns, letters):
    x = letters
    for _ in range(turns):
        x += x.translate(str.maketrans(letters, letters[::-1]))
    return x


def test_near_long_words_of_one_hash_stay_apart(spark):
    """Thue-Morse words collide in polynomial hashes modulo a power of two, whatever the base."""
    x, y = thue_morse(11, "ab"), thue_morse(11, "ba")
    w = words.words_of(pa.array([x, y]))
    assert w.hashes[0] == w.hashes[1]
    rows = [(1, f"p q r {x}", "en", "s"), (2, f"p q r {y}", "en", "s"), (3, f"p q r {x}", "en", "s")]
    got = {r.id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows), shingle=2).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_template_documents_do_not_meet(spark):
    """Documents that share 60 to 75 % of their words with all others are not compared pair by pair; links among them are kept."""
    rng = random.Random(3)
    form = [f"t{k}" for k in range(200)]
    sets = {}
    for i in range(300):
        own = rng.choice([46, 60, 80])
        sets[i] = {f"{i}x{k}" for k in range(own)} | set(form[: 200 - own // 2])
    for i in range(300, 310):
        sets[i] = set(sorted(sets[i - 300])[12:])
    hashed = {i: np.unique(np.array([int.from_bytes(hashlib.sha256(x.encode()).digest()[:8]) for x in v], np.uint64)) for i, v in sets.items()}
    some = spark.createDataFrame([(i, i, [1, 2]) for i in sets], "id long, comp long, buckets array<long>")
    held = spark.createDataFrame([(i, v.tobytes()) for i, v in hashed.items()], "id long, items binary")
    pairs = {tuple(r) for r in near_dedup.rare_pairs(some, held, 80).collect()}
    similar = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(similar) >= 10 and similar <= pairs and len(pairs) < 3 * len(sets)


def test_rare_pairs_lose_nothing(spark):
    """Sets of every overlap, ids with several sets, repeated rows: all similar pairs of different components are there."""
    rng = random.Random(8)
    rows = []
    for i in range(150):
        n = rng.randrange(5, 40)
        rows.append((i, set(rng.sample(range(50), n)) if i % 3 else set(range(n))))
    rows += [(k, set(rng.sample(range(50), 20))) for k in range(10)] + rows[:5]
    some = spark.createDataFrame([(i, i % 40, [7, i % 2]) for i in range(150)], "id long, comp long, buckets array<long>")
    held = spark.createDataFrame([(i, np.array(sorted(v), np.uint64).tobytes()) for i, v in rows], "id long, items binary")
    for percent in (50, 80, 95):
        pairs = {tuple(r) for r in near_dedup.rare_pairs(some, held, percent).collect()}
        want = {(a, b) for a, x in rows for b, y in rows if a < b and a % 40 != b % 40 and 100 * len(x & y) >= percent * len(x | y)}
        assert want and want <= pairs


@pytest.mark.parametrize("n", [1, 2, 5])
def test_near_small_sets_and_odd_rows(spark, odd, none, n):
    rows = [(k, " ".join(chr(97 + (k * j) % 7) for j in range(k % 9)), "en", "s") for k in range(60)]
    got = near_dedup.near_duplicates(frame(spark, rows), shingle=n)
    assert sorted(map(tuple, got.collect())) == near_brute([(r[0], r[1]) for r in rows], n)
    out = near_dedup.near_duplicates(odd, shingle=n).distinct().collect()
    assert sorted(map(tuple, out)) == near_brute([(r.doc_id, r.text) for r in odd.collect() if r.doc_id is not None], n)
    assert near_dedup.near_duplicates(none).count() == 0
    assert near_dedup.one_of_each(odd, shingle=n).columns == odd.columns


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(2)
    shared, own = rng.integers(0, 2**63, 300, dtype=np.uint64), rng.integers(0, 2**63, (2, 75), dtype=np.uint64)
    items = np.concatenate([shared, own[0], shared, own[1], shared[:1]])
    owner = np.repeat([0, 1, 2], [375, 375, 1])
    t = near_dedup.sketch(items, owner, 4, 400)
    assert (t[:3] != 2**64 - 1).all() and (t[3] == 2**64 - 1).all()
    assert abs((t[0] == t[1]).mean() - 300 / 450) < 0.1


def strip_brute(rows, n):
    first, out = {}, []
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - n + 1):
            key = tuple(w[k : k + n])
            first[key] = min(first.get(key, i), i)
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k : k + n])] < i:
                gone[k : k + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_substring_query(spark):
    assert sorted(map(tuple, QUERIES["op10_super_kmer_dedup"](spark, SF).collect())) == strip_brute(texts(spark), 13)


@pytest.mark.parametrize("window,bucket", [(1, 1 << 24), (2, 50), (3, 200), (13, 300)])
def test_substring_windows(spark, window, bucket):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randrange(60))), "en", "s") for i in range(40)]
    rows += [(100, "x " * 50, "en", "s"), (101, "x " * 70, "en", "s"), (102, rows[3][1], "en", "s")]
    got = substring_dedup.remove_repeats(frame(spark, rows).repartition(3), window=window, bucket_bytes=bucket)
    found = sorted((r.id, r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got.collect())
    assert found == strip_brute([(r[0], r[1]) for r in rows], window)


def test_substring_hash_collisions_are_told_apart(monkeypatch):
    """With all windows of one hash, the words decide."""
    rows = [(1, "a b c d e"), (2, "b c d e f"), (3, "q r s")]
    monkeypatch.setattr(substring_dedup, "span_hash", lambda running, start, end: np.zeros(len(start), np.uint64))
    lists = [np.array([0], np.int32), np.array([1], np.int64), np.array([0], np.int32)]
    z = substring_dedup.zstandard.ZstdCompressor().compress
    table = pa.table({
        "strings": [z(b"a b c d e "), z(b"b c d e f "), z(b"q r s ")], "code": [z(lists[0].tobytes())] * 3,
        "doc": [z(np.array([i], np.int64).tobytes()) for i, _ in rows], "at": [z(lists[2].tobytes())] * 3,
    })
    d, p, n = substring_dedup.repeated_windows(table, 3)
    assert (d.tolist(), p.tolist(), n.tolist()) == ([2], [0], [2])


def test_substring_odd_rows(odd, none):
    out = {r.id: r for r in substring_dedup.remove_repeats(odd, window=3).collect() if r.id is not None}
    assert out[2].n_words == 0 and out[3].kept == "" and out[5].n_removed < 30_000 and out[10].kept.endswith("tail")
    assert out[8].n_removed == 6 and out[1].n_removed == 0 and out[9].n_removed == 6 and len(LONG.split()) == out[5].n_words
    assert substring_dedup.remove_repeats(none).count() == 0
