"""Decontamination, secrets, pseudonyms, page text and toxicity against brute force and round trips."""

import base64
import hashlib
import json
import random
import re

import numpy as np
import pytest
from conftest import SF
from llm_frames import LONG, frame, none, odd  # noqa: F401
from pyspark.sql import functions as F

from delaylake.llm import decontamination, html_text, pii, secrets, toxicity
from delaylake.llm.queries import QUERIES


def edits_inside(item, text):
    """Least edits of the item against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def mutate(rng, text, n):
    text = list(text)
    for _ in range(n):
        k = rng.randrange(len(text))
        rng.choice([lambda: text.pop(k), lambda: text.insert(k, rng.choice("abcdefg ")), lambda: text.__setitem__(k, rng.choice("hijk"))])()
    return "".join(text)


def test_edits_within_budget_are_found(spark):
    rng = random.Random(4)
    filler = lambda n: "".join(rng.choice("abcdefghi ") for _ in range(n))
    items = [(k, filler(rng.choice([12, 20, 50, 90, 200]))) for k in range(8)] + [(8, "tiny"), (9, ""), (10, None)]
    docs = []
    for d in range(40):
        k = rng.randrange(8)
        docs.append((d, filler(rng.randrange(200)) + " " + mutate(rng, items[k][1], rng.randrange(0, 9)).upper() + "\n\t" + filler(rng.randrange(100)), "en", "s"))
    docs += [(100, "short tiny text", "en", "s"), (101, None, "en", "s"), (102, "", "en", "s")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {}
    for r in decontamination.contamination(frame(spark, docs).repartition(2), bench, block_chars=150).collect():
        got[(r.id, r.item)] = min(r.edits, got.get((r.id, r.item), 99))
    index = decontamination.index_items([(k, t) for k, t in items], 8, 0.1)
    budget = dict(zip(index.ids, index.budget.tolist(), strict=True))
    want = {}
    for d, t, _, _ in docs:
        for k, item in items:
            if item and (e := edits_inside(decontamination.normal(item), decontamination.normal(t))) <= budget[k]:
                want[(d, k)] = e
    assert got == want and len(want) > 20


def test_contamination_query_and_spans(spark):
    rows = QUERIES["op1_qgram_decontamination"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    n = decontamination.normal
    assert {(i, k) for i, t in docs.items() for k, b in bench.items() if n(b) in n(t)} <= {(r.doc_id, r.item_id) for r in rows}
    for r in rows:
        assert edits_inside(n(bench[r.item_id]), n(docs[r.doc_id][r.start : r.stop])) <= r.edits


def test_contamination_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(1, "Alpha  BETA gamma delta epsilon zeta"), (2, LONG[-500:]), (None, "one")], "item_id long, text string")
    got = {(r.id, r.item, r.edits) for r in decontamination.contamination(odd, bench).collect()}
    assert got == {(1, 1, 0), (8, 1, 0), (9, 1, 0), (5, 2, 0), (10, 2, 0)}
    left = decontamination.clean(odd, bench)
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == ["2", "3", "4", "6", "7", "None"] and left.columns == odd.columns
    assert decontamination.contamination(none, bench).count() == 0
    assert decontamination.contamination(odd, bench.limit(0)).count() == 0


BASE = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), lambda m: len(m[2]) >= 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 32),
]


def base_spans(text):
    return sorted((m.start(), k, name, m.end()) for k, (name, p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m))


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 + (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def integer(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


def sample_key():
    rng = random.Random(1)
    return der(0x30, integer(0), *[integer(rng.getrandbits(b)) for b in (1024, 17, 1020, 512, 512, 510, 511, 509)])


def test_secret_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op4_secret_structure"](spark, SF).collect():
        spans = base_spans(docs[r.doc_id])
        text = ",".join(f"{n}:{a}:{b}" for a, _, n, b in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == c for _, k, _, _ in spans) for c in range(3))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_base_rules_in_corner_cases():
    for t in ("secret=passwd:longvalue123", "TOKEN: 'abcdefgh'", "apiKey==x", "toKen=abcdefghij", "AKIA12AKIA" + "B" * 12, "a" * 31 + "g" + "f" * 33, "api_key  :  \"a.b-c/d+e=\" pAsSwD=12345678é"):
        assert [s for s in secrets.spans_of(t) if s[0] < 3] == [(k, a, b) for a, k, _, b in base_spans(t)]


def test_structure_confirms(spark, odd, none):
    key = base64.b64encode(sample_key()).decode()
    lines = "\n".join(key[k : k + 64] for k in range(0, len(key), 64))
    part = lambda d: base64.urlsafe_b64encode(json.dumps(d).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl"
    ssh = base64.b64encode(b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"k" * 40).decode()
    hits = lambda t: [(secrets.KINDS[k], t[a:b]) for k, a, b in secrets.spans_of(t) if k > 2]
    assert hits(f"x {key} y") == [("key", key)]
    assert hits(f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----") == [("key", lines)]
    assert hits("k " + sample_key().hex()) == [("key", sample_key().hex())]
    assert hits(f"ssh {ssh} end") == [("key", ssh)]
    assert hits(f"bearer {token}, ok") == [("token", token)]
    # One byte less, a wrong length inside, or a header without an algorithm: no find.
    assert not hits(base64.b64encode(sample_key()[:-1]).decode()) and not hits("MII" + "A" * 200)
    assert not hits(f"{part({'typ': 'JWT'})}.{part({'sub': '1'})}.c2ln")
    out = secrets.scan(odd)
    assert out.count() == odd.count() and out.filter("size(spans) > 0").count() == 0 and secrets.scan(none).count() == 0


def luhn(s):
    d = [int(c) for c in s[::-1]]
    return sum(d[::2]) % 10 == -sum(2 * x - 9 * (x > 4) for x in d[1::2]) % 10


def test_pseudonyms(spark):
    cards = [f"4{k:014d}" for k in range(300)]
    cards = [c + next(x for x in "0123456789" if luhn(c + x)) for c in cards]
    rows = [(k, f"mail a{k}.B_c@host{k}.example.com card {c} ip 10.{k % 256}.3.4 on {1950 + k % 100}-0{k % 9 + 1}-1{k % 10}, call +1 (017) 555-{7000 + k}.", "en", "s") for k, c in enumerate(cards)]
    rows += [(1000, rows[0][1], "en", "s"), (1001, "ip 300.1.1.1 on 2023-02-30 and 1850-01-01; DE89 3704 0044 0532 0130 00 or DE89370400440532013000", "en", "s")]
    out = {r.doc_id: r for r in pii.pseudonymise(frame(spark, rows).select("doc_id", "text"), "k").collect()}
    form = re.compile(r"mail (\S+)@(\S+)\.com card (\d{16}) ip (\S+) on (\d{4}-\d\d-\d\d), call \+1 \((\d{3})\) (\d{3}-\d{4})\.$")
    seen = [form.match(out[k].text).groups() for k in range(300)]
    assert all(luhn(s[2]) for s in seen) and not any(c in out[k].text for k, c in enumerate(cards)) and out[0].n_values == 5
    for part in (2, 3, 6):
        assert len({s[part] for s in seen}) == 300 or part == 3
    assert out[1000].text == out[0].text
    assert all(0 <= int(x) <= 255 for s in seen for x in s[3].split(".")) and all("1901" <= s[4][:4] <= "2099" for s in seen)
    assert out[1001].text.startswith("ip 300.1.1.1 on 2023-02-30 and 1850-01-01; DE")
    ibans = re.search(r"; (DE.+) or (DE\S+)", out[1001].text).groups()
    assert ibans[0].replace(" ", "") == ibans[1] != "DE89370400440532013000"
    assert int("".join(str(int(c, 36)) for c in ibans[1][4:] + ibans[1][:4])) % 97 == 1
    other = pii.pseudonymise(frame(spark, rows[:1]).select("doc_id", "text"), "other").first()
    assert other.text != out[0].text


def test_number_permutation(spark):
    n = pii.DAY_ROWS * pii.DAY_COLUMNS
    days = spark.range(0, n, 1).select(pii.feistel_number(F.col("id"), pii.DAY_ROWS, pii.DAY_COLUMNS, "k").alias("x"))
    assert tuple(days.agg(F.min("x"), F.max("x"), F.countDistinct("x")).first()) == (0, n - 1, n)


def test_pseudonyms_of_odd_rows(odd, none):
    out = pii.pseudonymise(odd, "k")
    assert sorted(map(repr, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(repr, ((r.doc_id, r.text) for r in odd.collect())))
    assert set(out.columns) == set(odd.columns) and pii.pseudonymise(none, "k").count() == 0


def test_page_query(spark):
    import html as entities

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op7_min_cut_text"](spark, SF).collect():
        inner = re.sub(r"<footer>.*|</article>.*", "", pages[r.page_id].split("<article>", 1)[1], flags=re.S)
        parts = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>?", lambda m: " " if m[0].startswith("<br") else "", x))).strip() for x in re.split(r"</?(?:p|h1)\b[^>]*>?", inner)]
        assert r.text == "\n\n".join(x for x in parts if x) and r.n_chars == len(r.text)


PAGE = """<html><head><title>T</title><script>var a = "</p><p>x";</script></head><body><header><p>A slogan of many words, here for everyone to read.</p></header>
<nav><ul><li><a href=/a>One</a><li><a href="/b">Two</a></ul></nav><div class="cookie-notice"><p>We use cookies to improve what you see here, please accept.</p></div>
<article><h1>Head &amp; <i>line</i></h1><p>First &lt;para&gt; with a <a href='x'>link</a> and
 more   words.<p>Second,<br>with a break.</p><ul><li>one<li>two</ul><section class="comments"><p>A reader writes a long remark about all of this.</p></section></article>
<aside><p>Another story that one could read, if one wanted.</p></aside><form><p>Subscribe to letters that nobody reads, ever.</p></form><footer>&copy; us</footer>"""


def test_page_parts():
    assert html_text.main_text(PAGE) == "Head & line\n\nFirst <para> with a link and more words.\n\nSecond, with a break.\n\none\n\ntwo"
    for cut in range(0, len(PAGE), 7):
        html_text.main_text(PAGE[:cut])
    assert html_text.main_text("<a href=\"x") == "" and html_text.main_text("<<<>>><p") != "x"


def test_minimum_cut_equals_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        blocks = [html_text.Block(rng.randrange(3), *[rng.random() < 0.1 for _ in range(6)], text=" ".join(["w"] * rng.randrange(1, 30)) + rng.choice([".", ""])) for _ in range(7)]

        def cost(keep, blocks=blocks):
            total = sum(abs(int(html_text.odds(b) * 1000)) for b, k in zip(blocks, keep, strict=True) if (html_text.odds(b) > 0) != k)
            total += sum(350 for a, b in zip(keep, keep[1:]) if a != b)
            for p in {b.parent for b in blocks}:
                of = [k for b, k in zip(blocks, keep, strict=True) if b.parent == p]
                total += 350 * min(sum(of), len(of) - sum(of))
            return total

        best = min(cost([bool(m >> k & 1) for k in range(7)]) for m in range(128))
        assert cost(html_text.content(blocks)) == best


def test_page_odd_rows(spark, none):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "plain words only, no markup at all in this."), (None, PAGE), (5, "<p>" + LONG + ".</p>")], "page_id long, html string")
    out = {r.id: r.text for r in html_text.extract(rows.withColumn("text", F.lit(1))).collect()}
    assert out[1] == out[2] == "" and out[3].startswith("plain") and out[None].startswith("Head") and len(out[5]) == len(LONG) + 1
    assert html_text.extract(rows.limit(0)).count() == 0


@pytest.fixture(scope="module")
def insults(spark):
    rng = random.Random(6)
    clean = [f"{a}{b}" for a in ("ber", "lon", "mi", "sta", "ro") for b in ("en", "a", "tion", "es", "ul", "ing", "o")]
    rows, marks = [], []
    for i in range(900):
        lang, bad = rng.choice(["en", "de"]), rng.random() < 0.2
        w = [rng.choice(clean) for _ in range(rng.randrange(5, 80))]
        for _ in range(2 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["nasty,", "Vile!"]) if lang == "en" else f"boes{rng.choice(clean)}")
        rows.append((i, " ".join(w), lang, "s"))
        marks.append((i, 1, int(bad)))
    return frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(insults, odd, none):
    docs, labels = insults
    model = toxicity.fit(toxicity.labelled(docs, labels), n_slots=1 << 14)
    out = toxicity.score(docs, model).join(labels, F.col("id") == F.col("doc_id")).withColumn("held", toxicity.held_out(F.col("id"))).collect()
    held = [r for r in out if r.held]
    hit = sum(r.toxic and r.score >= 0.7 for r in held)
    assert len(held) > 200 and hit / sum(r.toxic for r in held) > 0.9 and hit / max(1, sum(r.score >= 0.7 for r in held)) > 0.9
    assert toxicity.labelled(docs, labels).filter(toxicity.held_out(F.col("id"))).count() == 0
    # The score does not see language, source or id.
    moved = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None), "doc_id": F.col("doc_id") + 5000})
    assert sorted(r.score for r in toxicity.score(moved, model).collect()) == sorted(r.score for r in out)
    scores = {r.id: r.score for r in toxicity.score(odd, model).collect()}
    assert len(scores) == 11 and scores[2] == scores[3] == scores[4] and all(0 <= s <= 1 for s in scores.values())
    assert toxicity.score(none, model).count() == 0
    left = toxicity.reject(docs, model)
    assert left.columns == docs.columns and 0.75 < left.count() / 900 < 0.85


def test_toxicity_without_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    for rows in (toxicity.labelled(odd, labels), toxicity.labelled(none, labels)):
        model = toxicity.fit(rows, n_slots=64)
        assert all(r.score < 1e-9 and not r.rejected for r in toxicity.score(odd, model).collect())
        assert toxicity.reject(odd, model).count() == odd.count()


def test_gradients_lower_the_loss():
    rng = np.random.default_rng(0)
    slots = [rng.integers(0, 50, (rng.integers(1, 20), 4)).astype(np.int32) for _ in range(200)]
    labels = np.array([float((s[:, 0] == 7).any()) for s in slots], np.float32)
    m = toxicity.fit_numpy(slots, labels, np.ones(200, np.float32), 64, epochs=20)
    p = toxicity.sigmoid(np.concatenate([toxicity.logits(m, s, np.array([len(s)])) for s in slots]))
    assert ((p > 0.5) == labels).mean() > 0.95


def small_p256_key():
    """PKCS 8 for P-256 without the public part: 67 bytes, MEECAQ... in base64."""
    algorithm = der(0x30, der(6, bytes.fromhex("2a8648ce3d0201")) + der(6, bytes.fromhex("2a8648ce3d030107")))
    return der(0x30, der(2, b"\x00") + algorithm + der(4, der(0x30, der(2, b"\x01") + der(4, bytes(range(1, 33))))))


@pytest.mark.parametrize("form", ["PRIVATE_KEY={}", "key: |\n    {}\n", "'{}'", "k={}\nwords that follow the key", "{}\nlettersonly\nmore"])
def test_keys_in_the_forms_of_real_files(form):
    import base64

    raw = small_p256_key()
    coded = base64.b64encode(raw).decode()
    assert coded.startswith("MEECAQ")
    lines = coded[:64] + ("\n    " if "|" in form else "\n") + coded[64:]
    for body in (coded, lines, coded.rstrip("="), lines.rstrip("=")):
        text = form.format(body)
        at = text.index("MEE")
        assert (3, at, at + len(body)) in secrets.spans_of(text), text
    # An item of another kind where the version stands.
    broken = base64.b64encode(raw[:2] + b"\x05" + raw[3:]).decode()
    assert not [s for s in secrets.spans_of(form.format(broken.rstrip("="))) if s[0] == 3]


def test_long_runs_without_spaces_are_read_once(spark):
    import time

    run = "ab1" * 350_000
    t0 = time.time()
    secrets.spans_of("M" + run)
    assert time.time() - t0 < 4
    t0 = time.time()
    rows = spark.createDataFrame([(1, run), (2, run + "@x.org")], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(rows, "k").select("doc_id", "n_values").collect()}
    assert got[1].n_values == 0 and time.time() - t0 < 60


def test_only_numbers_with_right_check_digits_are_personal(spark):
    texts = ["at 1700000000000 ms", "order 12345678901234", "isbn 9780306406157", "card 4111 1111 1111 1111", "card 4111 1111 1111 1112", "DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", "1.2.3.4", "01.2.3.4"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r.n_values for r in pii.pseudonymise(rows, "k").orderBy("doc_id").collect()]
    luhn = lambda s: sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(s))) % 10 == 0
    assert got == [int(luhn("1700000000000")), int(luhn("12345678901234")), int(luhn("9780306406157")), 1, 0, 1, 0, 1, 0]


LONG_COMMENT = "I have read this piece twice now and I must say that the author is quite wrong about the whole matter, as anyone who has ever lived there for some years could have told them at once without any trouble at all."


@pytest.mark.parametrize("page", [
    "<html><body><article><h1>Title</h1><p>{a}</p><p>{a}</p><div class='comments'><p>{c}</p><p>{c}</p></div></article></body></html>",
    "<html><body><main><article><h1>Title</h1><p>{a}</p><p>{a}</p><section id='comments'><div><p>{c}</p></div></section></article></main></body></html>",
    "<html><body><main><article><h1>Title</h1><p>{a}</p><aside><p>{c}</p></aside><p>{a}</p></article></main></body></html>",
    "<html><body><article><p>{a}</p><div class='ad'><p>{c}</p></div><p>{a}</p></article><section class='comments'><article><p>{c}</p></article></section></body></html>",
])
def test_long_parts_beside_the_text_stay_out(page):
    article = "The river rose by two metres overnight, and by morning the lower streets of the town were under water."
    text = html_text.main_text(page.format(a=article, c=LONG_COMMENT))
    assert text.count(article) == 2 and "author is quite wrong" not in text


def test_short_pages_and_broken_quotes():
    assert html_text.main_text("<p>Hello there</p>") == "Hello there"
    assert html_text.main_text("<nav><a href='/'>Home</a></nav><p>Hello there</p>") == "Hello there"
    page = "<body><p>First words of the page stand here.</p><a href=\"x>link</a><p>Second words of the page stand here.</p></body>"
    assert "First words" in html_text.main_text(page) and "Second words" in html_text.main_text(page)
    assert html_text.main_text("<p title='a > b'>Kept as it is, with a sign in a quoted value.</p>") == "Kept as it is, with a sign in a quoted value."


def test_toxicity_learns_from_every_labelled_row(spark):
    """One insult stands only in rows that a sample by hash order of a few thousand rows a class leaves out."""
    rng = random.Random(8)
    clean = [f"{a}{b}" for a in ("ber", "lon", "mi", "sta") for b in ("en", "a", "tion", "es")]
    rows, marks = [], []
    for i in range(15_000):
        w = [rng.choice(clean) for _ in range(rng.randrange(3, 8))]
        bad = i % 2
        rows.append((i, " ".join([*w, "vile"] if bad else w), "en", "s"))
        marks.append((i, 1, bad))
    docs, labels = frame(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    known = toxicity.labelled(docs, labels)
    seen = {r.id for r in known.select("id").collect()}
    assert seen == {r.doc_id for r in docs.filter(~toxicity.held_out(F.col("doc_id"))).select("doc_id").collect()} and len(seen) > 9000
    # The last 40 toxic rows in hash order, where a sample would end, hold the only new insult.
    late = {r.id for r in known.filter("label = 1").orderBy(F.xxhash64("label", "id").desc()).limit(40).select("id").collect()}
    docs = frame(spark, [(i, t.replace("vile", "zwork") if i in late else t, x, s) for i, t, x, s in rows])
    model = toxicity.fit(toxicity.labelled(docs, labels), n_slots=1 << 14)
    new = frame(spark, [(1, "beren zwork mia", "en", "s"), (2, "beren mia loa", "en", "s"), (3, "staes vile mia", "en", "s")])
    got = {r.id: r.score for r in toxicity.score(new, model).collect()}
    assert got[1] >= 0.7 and got[3] >= 0.7 and got[2] < 0.3


def test_toxicity_of_many_parts(insults):
    docs, labels = insults
    scored = []
    for shuffled in (docs, docs.repartition(5)):
        rows = toxicity.labelled(shuffled, labels, part_bytes=20_000)
        assert rows.rdd.getNumPartitions() > 3
        model = toxicity.fit(rows, n_slots=1 << 14)
        scored.append({r.id: r.score for r in toxicity.score(docs, model).collect()})
    # What is learned follows from the rows, not from how they are partitioned.
    assert scored[0] == scored[1]
    held = [(scored[0][r.doc_id], r.toxic) for r in labels.filter(toxicity.held_out(F.col("doc_id"))).collect()]
    assert sum(t and s >= 0.7 for s, t in held) / sum(t for _, t in held) > 0.85 and sum(not t and s >= 0.7 for s, t in held) < 10


def test_best_cut_of_counted_values():
    values, labels = np.array([3.0, 2.0, 2.0, 1.0, -1.0]), np.array([1, 1, 0, 1, 0])
    assert toxicity.best_cut(values, labels, np.ones(5)) == 0.0
    assert toxicity.best_cut(np.array([3.0, 2.0, 1.0, -1.0]), np.array([1, 1, 1, 0]), np.array([1, 2, 1, 1])) == 0.0
