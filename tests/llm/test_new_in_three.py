"""Conversation repair, suffix dedup and phrases against brute force."""

import hashlib
import inspect
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from llm_frames import frame, none, odd  # noqa: F401

from delaylake.llm import conversation_repair as repair
from delaylake.llm import phrases, suffix_dedup
from delaylake.llm.queries import QUERIES

GRAMMAR = re.compile(r"(s?(ua)+)?")


def edits(codes):
    """Every order of edits with at most two insertions a gap: (cost, audit) of those the grammar takes."""
    best = None
    moves = {c: [(4, "D", "")] + ([] if c[1] in "bd" else [(x + 3 * (c[1] == "t"), y, z) for x, y, z in ((0, "K", c[0]), (3, "R", "u"), (3, "R", "a"))]) for c in set(codes)}
    gaps = ["".join(g) for n in range(3) for g in itertools.product("ua", repeat=n)]
    for chosen in itertools.product(*(moves[c] for c in codes)):
        for put in itertools.product(gaps, repeat=len(codes) + 1):
            roles = put[0] + "".join(m[2] + p for m, p in zip(chosen, put[1:], strict=True))
            if GRAMMAR.fullmatch(roles):
                audit = "I" * len(put[0]) + "".join(m[1] + "I" * len(p) for m, p in zip(chosen, put[1:], strict=True))
                new = (sum(m[0] for m in chosen) + 3 * len("".join(put)), audit)
                best = new if best is None or new < best else best
    return best


def left_to_right(codes):
    """The same minimum row by row, for longer conversations."""
    now = {0: (0, "")}
    def insert(now):
        for _ in range(3):
            for p, (c, a) in list(now.items()):
                for r in "ua":
                    q = repair.STEP.get((p, r))
                    if q is not None and (c + 3, a + "I") < now.get(q, (c + 4, "")):
                        now[q] = (c + 3, a + "I")
        return now
    insert(now)
    for role, fault in codes:
        after = {}
        for p, (c, a) in now.items():
            ways = [(p, 4, "D")]
            if fault not in "bd":
                ways += [(repair.STEP.get((p, to)), cost + 3 * (fault == "t"), x) for to, cost, x in ((role, 0, "K"), ("u", 3, "R"), ("a", 3, "R"))]
            for q, cost, x in ways:
                if q is not None and (q not in after or (c + cost, a + x) < after[q]):
                    after[q] = (c + cost, a + x)
        now = insert(after)
    return min(v for q, v in now.items() if q in (0, 3))


def chart_of(codes):
    chart = repair.Chart()
    for c in codes:
        chart.add(c)
    return repair.cheapest(chart.cell())


CODES = [r + f for r in "usa " for f in "bdt-"]


def test_short_repairs_equal_all_edits():
    rng = random.Random(3)
    assert chart_of([]) == (0, "")
    for n in (1, 2, 3):
        for _ in range(60 if n < 3 else 40):
            codes = [rng.choice(CODES) for _ in range(n)]
            assert chart_of(codes) == edits(codes) == left_to_right(codes)


def test_any_split_gives_the_same_cell():
    rng = random.Random(4)
    for _ in range(15):
        codes = [rng.choice(CODES) for _ in range(9)]
        chart = {(i, i + 1): repair.row_cell(c) for i, c in enumerate(codes)}
        for size in range(2, 10):
            for i in range(10 - size):
                cells = [repair.product(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size)]
                assert all(c == cells[0] for c in cells)
                chart[i, i + size] = cells[0]
    for n in (17, 64, 300):
        codes = [rng.choice(CODES) for _ in range(n)]
        assert chart_of(codes) == left_to_right(codes)


def damaged(rows):
    out = {}
    text = lambda x: " " if x is None else str(x)
    order = lambda r: (r[1] is not None, r[1] or 0, text(r[2]), hashlib.sha256(f"{text(r[2])}\x1f{text(r[3])}".encode()).hexdigest())
    for conv, turn, role, words in sorted(rows, key=order):
        lines = out.setdefault(conv, [])
        k = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, words = text(role), text(words)
        if k == 0:
            continue
        words = "" if k == 1 else re.sub("[.!?]", "", words) if k == 2 else words
        lines += [(turn, "user" if k == 4 else role, words)] * (2 if k == 3 else 1)
    return out


def repaired_brute(rows):
    out = []
    for conv, lines in damaged(rows).items():
        seen, codes, counts, illegal = set(), [], Counter(), 0
        for n, (_, role, words) in enumerate(lines):
            last = re.findall(r"[^\x20\x09-\x0D]", words)[-1:]
            fault = "b" if not last else "d" if (role, words) in seen else "t" if last[0] not in ".!?" else "-"
            seen.add((role, words))
            counts[fault] += 1
            codes.append((role[:1], fault))
            illegal += n > 0 and lines[n - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        turns = [t for t, _, _ in lines if t is not None]
        cost, audit = left_to_right(codes)
        left, state, at, held = iter(lines), 0, 0, []
        for letter in audit:
            if letter == "I":
                role, words = None, ""
            else:
                _, role, words = next(left)
            if letter == "D":
                continue
            to = role[:1] if letter == "K" else "a" if state == 2 else "u"
            held.append(f"{role if letter == 'K' else repair.ROLE[to]}:{words}")
            state = repair.STEP[state, to]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["b"], counts["d"], counts["t"], illegal, cost, audit, hashlib.sha256("\n".join(held).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def test_repair_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_interval_repair"](spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == repaired_brute(rows)


def test_repair_of_odd_rows_and_a_long_conversation(spark, tmp_path):
    rng = random.Random(6)
    texts = ["Fine.", "no end", "", " \t", None, "Ask?", "é!", "x. y", "Fine. \n"]
    rows = [(c, rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(texts)) for c in [1, 2, 3, None] for _ in range(25)]
    rows += [(9, t, rng.choice(["user", "assistant"]), rng.choice(texts) if t % 3 else f"line {t}.") for t in range(1500)]
    rows += [(9, 77, "user", "same again.")] * 40 + [(5, 3, "user", "one.")] + [(c, 0, "user", "Only.") for c in range(100, 140)]
    schema = "conv_id long, turn long, role string, text string, conv string, part string, kind string, `first` string, cell string"
    spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], schema).repartition(5).write.parquet(f"{tmp_path}/a/conversations.parquet")
    got = sorted(map(tuple, QUERIES["op11_interval_repair"](spark, f"{tmp_path}/a").collect()), key=repr)
    assert got == repaired_brute(rows)
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert QUERIES["op11_interval_repair"](spark, f"{tmp_path}/b").count() == 0


def test_columns_equal_sorted_suffixes():
    rng = random.Random(1)
    for n, size, letters in ((1, 5, "a"), (4, 9, "ab"), (30, 40, "abc"), (50, 100, "abcdefgh"), (3, 0, "a")):
        strings = ["".join(rng.choice(letters) for _ in range(rng.randrange(size + 1))).encode() for _ in range(n)] + [b"ab" * 3] * 2
        lengths = np.array([len(s) for s in strings])
        before, prefix, owner, sizes = suffix_dedup.insert_columns(np.frombuffer(b"".join(strings), np.uint8), np.cumsum(lengths), lengths)
        # The end of string k is a symbol below all bytes, and below that of string k + 1.
        suffixes = sorted(([256 + b for b in s[len(s) - z :]] + [k], k, z) for k, s in enumerate(strings) for z in range(len(s) + 1))
        assert [(k, z) for _, k, z in suffixes] == list(zip(owner.tolist(), sizes.tolist(), strict=True))
        common = [next((i for i, (x, y) in enumerate(zip(a[0], b[0], strict=False)) if x != y), 0) for a, b in itertools.pairwise(suffixes)]
        assert prefix.tolist() == [0, *common]
        assert before.tolist() == [strings[k][len(strings[k]) - z - 1] if z < len(strings[k]) else suffix_dedup.NO_SYMBOL for _, k, z in suffixes]


def test_seed_hashes_tell_equal_strings():
    data = np.frombuffer(b"abcabcabcabxabcabcabc" * 3, np.uint8)
    for width in (1, 2, 3, 7, 24):
        h = suffix_dedup.seed_hashes(data, width)
        held = [bytes(data[k : k + width]) for k in range(len(data) - width + 1)]
        assert len(h) == len(held) and len(set(zip(h.tolist(), held, strict=True))) == len(set(h.tolist())) == len(set(held))


def bytes_brute(rows, n):
    least, out = {}, []
    held = [(i, (t or "").encode()) for i, t in rows]
    for i, b in held:
        for k in range(len(b) - n + 1):
            if i is not None:
                least[b[k : k + n]] = min(least.get(b[k : k + n], i), i)
    for i, b in held:
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if i is not None and least[b[k : k + n]] < i:
                gone[k : k + n] = b"\x01" * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_column_suffix_dedup"](spark, SF).collect()), key=repr) == bytes_brute(rows, 50)


@pytest.mark.parametrize("window,run,bucket,crowd", [(2, 60, 50, 10**6), (5, 300, 400, 3), (30, 1 << 20, 1 << 20, 10**6), (50, 500, 1000, 5)])
def test_suffix_windows(spark, window, run, bucket, crowd):
    rng = random.Random(window)
    words = ["alpha", "beta gamma", "é漢", "ab", "delta epsilon zeta eta theta", "x" * 30]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(25))), "en", "s") for i in range(50)]
    rows += [(100, "x" * 700, "en", "s"), (101, "x" * 401 + "y", "en", "s"), (102, rows[3][1], "en", "s"), (103, "short", "en", "s"), (None, rows[4][1], "en", "s")]
    # One id twice: neither takes from the other.
    rows += [(105, "own text of this id, long enough to be a window of any size here", "en", "s")] * 2
    got = suffix_dedup.remove_repeated_bytes(frame(spark, rows).repartition(3), window=window, run_bytes=run, bucket_bytes=bucket, crowd=crowd)
    found = sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got.collect()), key=repr)
    assert found == bytes_brute([(r[0], r[1]) for r in rows], window)


def test_suffix_odd_rows(odd, none):
    got = suffix_dedup.remove_repeated_bytes(odd, window=20).collect()
    found = sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=repr)
    assert found == bytes_brute([(r.doc_id, r.text) for r in odd.collect()], 20)
    assert suffix_dedup.remove_repeated_bytes(none).count() == 0


def phrases_brute(rows, least, share, top, longest=4):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, count in f.items():
        good = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in good.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if 100 * a >= share * count[p[i : i + k]]:
                        inside.add(p[i : i + k])
        rank = []
        for p, a in good.items():
            score, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            if p not in inside:
                rank.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for r, (s, a, p, left, right) in enumerate(sorted(rank)[:top], 1):
            out.append((lang, r, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def test_phrase_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang").collect()]
    got = QUERIES["op13_stream_collocations"](spark, SF)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == phrases_brute(rows, 30, 80, 2000)


@pytest.mark.parametrize("least,share,top,run", [(1, 80, 50, 40), (2, 50, 10**6, 200), (3, 100, 5, 1 << 20), (300, 80, 10, 500)])
def test_phrases_of_small_texts(spark, least, share, top, run):
    rng = random.Random(least)
    words = ["New", "york", "city", "é", "a b", "x.", "y,", "\x1c", "of", "the"]
    rows = [(i, " \t"[i % 2].join(rng.choice(words) for _ in range(rng.randrange(40))), rng.choice(["en", None, "und", "de"]), "s") for i in range(60)]
    rows += [(100, "san jose " * 400, "en", "s"), (101, None, "en", "s"), (102, "", "fr", "s"), (103, ".;\n", None, "s")]
    got = phrases.collocations(frame(spark, rows).repartition(3), least=least, share=share, top=top, run_bytes=run)
    assert sorted(map(tuple, got.collect())) == phrases_brute([(r[1], r[2]) for r in rows], least, share, top)


def test_phrases_of_languages_with_line_breaks(spark):
    rows = [(i, "San Jose is near. San Jose", lang, "s") for i, lang in enumerate(["a\nb", "a\nb", "a", "\n", "", None])]
    got = phrases.collocations(frame(spark, rows), least=2)
    assert sorted(map(tuple, got.collect())) == phrases_brute([(r[1], r[2]) for r in rows], 2, 80, 2000)


def test_memory_of_a_run_of_phrases():
    size = inspect.signature(phrases.collocations).parameters["run_bytes"].default
    words = [f"word{k}" for k in range(5000)]
    rng = random.Random(5)
    text = [" ".join(rng.choice(words) for _ in range(1000)) + "." for _ in range(size // 9000)]
    batch = pa.table({"text": text, "lang": ["en"] * len(text)}).to_batches()[0]
    held = sum(map(len, text))
    tracemalloc.start()
    try:
        phrases.Grams(batch, phrases.LONGEST).values(40)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # Two tasks share an executor with its JVM.
    assert held > 0.9 * size and peak < 32 * size


def test_phrases_of_odd_rows(odd, none):
    got = phrases.collocations(odd, least=2)
    assert sorted(map(tuple, got.collect())) == phrases_brute([(r.text, r.lang) for r in odd.collect()], 2, 80, 2000)
    assert phrases.collocations(none).count() == 0
