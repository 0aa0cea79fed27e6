"""Each operation against brute force on small tables with nulls, ties, repeats, long texts and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import base64
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from skein.llm import decontaminate, fingerprints, html_extract, language_id, lm_scoring, simhash, substring_dedup, token_counts, warc
from skein.llm.bpe import ByteBpe, bpe_encode
from skein.llm.words import LOWER, all_words

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
#: Columns whose names the operators use themselves.
CLASH = ("k", "t", "h", "s", "fp", "text_", "score", "n_words", "spans", "next", "_range", "hashes", "component_id")


def clash(df):
    return df.withColumns({c: F.lit(1) for c in CLASH})


def texts(seed=1, n=120):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(["the", "an", "Er", "on", "é", "st", "x9", "."]) for _ in range(rnd.randint(1, 4)))
    passage = " ".join(word() for _ in range(40))
    out = [" ".join(word() for _ in range(rnd.randint(1, 120))) for _ in range(n)]
    out += [t + " tail" for t in out[:15]] + out[:10] + [f"{t}\n\n {passage}\t{t}" for t in out[20:35]]
    return out + [None, "", " \t\n", "one", "two words", "word " * 30_000, "a" * 5000, "\x1c\x85\xa0 ² ½ 中文 😀 <|endoftext|>"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 + 5, t) for i, t in enumerate(texts())] + [(None, "no id at all, but a text that is long enough to have windows of thirteen words")]
    return spark.createDataFrame(rows + [rows[0]], "doc_id long, text string").transform(clash).cache()


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def words(t):
    return (t or "").encode().split()


def empty(docs):
    return docs.limit(0)


def test_words(docs):
    import pyarrow as pa

    t = [x for _, x in pairs(docs)]
    h, c = all_words(pa.array(t, pa.string()))
    flat = [w for x in t for w in words(x)]
    assert c.tolist() == [len(words(x)) for x in t]
    assert len(set(zip(flat, h.tolist(), strict=True))) == len(set(flat)) == len(np.unique(h))
    assert len(np.unique(all_words(pa.array(t, pa.string()), fold=LOWER)[0])) == len({w.lower() for w in flat})


def test_token_counts(spark, docs):
    want = Counter((i, len(TIKTOKEN.encode_ordinary(t or ""))) for i, t in pairs(docs))
    assert Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs).collect()) == want
    assert token_counts.count_tokens(empty(docs)).count() == 0


@pytest.mark.parametrize("block", [4, 6, 64, 1 << 20])
def test_separator_scan(spark, tmp_path, block):
    rnd = random.Random(block)
    want = set()
    for name in "abcd":
        ids = [rnd.choice([1, 2, 50256, 50256 >> 8]) for _ in range({"a": 0, "b": 1}.get(name, 200))] + ([50256] if name == "c" else [])
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
        start = n = 0
        for i, x in enumerate([*ids, None]):
            if x == 50256 or (x is None and i > start):
                want.add((name, n, start, i - start, x is not None))
                start, n = i + 1, n + 1
    files = spark.createDataFrame([(f"file://{tmp_path}/{n}",) for n in "abcd"], "file string")
    got = {(r.file[-1], r.ordinal, r.start, r.n_tokens, r.closed) for r in token_counts.scan_token_files(spark, files, block_bytes=block).collect()}
    assert got == want


def test_language_id(spark):
    from pathlib import Path

    sf = "/root/testdata/sf0.01"
    assert Path(sf).exists()
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(d, "crc32(cast(doc_id as string)) % 3 <> 1")
    r = [x for x in language_id.identify(d, model).collect() if zlib.crc32(str(x.doc_id).encode()) % 3 == 1]
    assert sum(x.lang == x.lang_pred for x in r) / len(r) > 0.98 and all(0 <= x.score <= 1 for x in r)
    odd = spark.createDataFrame([(None, 1), ("", 1), ("123 !?", 1), ("the and of that", 1)], "text string, score int")
    got = language_id.identify(odd, model).collect()
    assert [x.lang_pred for x in got[:3]] == ["und"] * 3 and got[3].lang_pred in model.languages and "score_id" in got[0].asDict()
    assert language_id.train(d.withColumn("lang", F.lit(None).cast("string")), "true") is None
    assert {x.lang_pred for x in language_id.identify(odd, None).collect()} == {"und"}
    long = "".join(f"{chr(97 + i % 26)}é{i} " for i in range(400))
    for piece in (1, 2, 3, 7, 100):
        assert np.array_equal(language_id.features([long, "a", " ", ""], piece=piece)[0], language_id.features([long, "a", " ", ""])[0])
    code = language_id.codewords(30)
    assert min((code[i] != code[j]).sum() for i in range(30) for j in range(i)) > code.shape[1] // 4


def test_language_is_decoded_as_written_down(spark):
    """One text at a time in plain Python: margins of all bits, losses weighted by trust, the language of the least loss."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(d, "doc_id % 2 = 0")
    some = d.filter("doc_id % 17 = 3").union(d.filter("doc_id = 3")).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(d, model).collect()}
    for r in some:
        x = language_id.features([r.text])[0][0].astype(float)
        margin = [sum(a * b for a, b in zip(x, w, strict=True) if a) + c for w, c in zip(model.weights.T.astype(float), model.bias.astype(float), strict=True)]
        loss = [sum(t * np.log1p(np.exp(-k * m)) for t, k, m in zip(trust, code, margin, strict=True)) for trust, code in zip(model.trust, model.code.astype(float), strict=True)]
        p = np.exp(-(np.array(loss) - min(loss)) * len(margin))
        assert got[r.doc_id][0] == model.languages[int(np.argmin(loss))] and abs(got[r.doc_id][1] - p.max() / p.sum()) < 1e-3
    twice = d.filter("doc_id < 20")
    assert Counter(map(tuple, language_id.identify(twice.union(twice), model).collect())) == Counter({tuple(r): 2 for r in language_id.identify(twice, model).collect()})


def test_warc_repeated_rows(spark):
    html = "x" * 2000
    d = spark.createDataFrame([(1, "u", html), (1, "u", html), (5, "v", html), (5, "v", html), (6, "w", "small"), (6, "w", "small")], "page_id long, url string, html string")
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.warc_round_trip(d).collect())
    assert sum(got.values()) == 6 and got[1, "revisit", 5] == 2 and got[6, "response", None] == 2 and got[5, "response", None] >= 1


def test_language_sample(spark):
    rows = [(f"common text {i % 3}", "aa") for i in range(3000)] + [(f"word {i} other", "bb") for i in range(2000)] + [("rare one", "cc"), (None, "dd"), ("x", None)]
    d = spark.createDataFrame(rows, "text string, lang string")
    for sample, most in ((50, 1000), (500, 60)):
        model = language_id.train(d, "true", sample=sample, most=most)
        assert model.languages == ["aa", "bb", "cc"]  # few distinct texts, and one, are learned too
    assert [r.lang_pred for r in language_id.identify(d.filter("lang = 'bb'").limit(5), model).collect()] == ["bb"] * 5
    assert language_id.train(d.limit(0), "true") is None and language_id.identify(d.limit(0), model).count() == 0


def test_fingerprints_want_numbers(spark):
    with pytest.raises(TypeError):
        fingerprints.fingerprint_documents(spark.createDataFrame([("a", "b")], "doc_id string, text string"))
    with pytest.raises(TypeError):
        substring_dedup.relative_lz_dedup(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_token_ids_that_do_not_fit(spark, docs):
    with pytest.raises(Exception, match="separator"):
        token_counts.write_token_files(docs, separator=RANKS[b"the"])


def test_factors():
    covered, source = np.array([1, 1, 0, 1, 1, 1, 0, 0], bool), np.array([4, 4, 9, 4, 4, 6, 0, 0])
    place = np.array([7, 8, 0, 9, 20, 21, 0, 0])
    found = substring_dedup.factors(covered, source, place, 3)
    assert found == [(0, 4, 4, 7), (3, 6, 4, 9), (4, 7, 4, 20), (5, 8, 6, 21)] and substring_dedup.spans_of(found) == [(0, 8)]


def test_factors_name_their_source(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    d = spark.createDataFrame([(1, a), (2, b), (3, f"x {b} y {a} z"), (4, f"{a} {b}")], "doc_id long, text string")
    got = {r.doc_id: (r.kept_text, [tuple(f) for f in r.factors]) for r in substring_dedup.relative_lz_dedup(d).collect()}
    assert got[3] == ("x y z", [(1, 31, 2, 0), (32, 62, 1, 0)]) and got[4] == ("", [(0, 30, 1, 0), (30, 60, 2, 0)])


def test_factors_stand_in_their_source(spark):
    w = [f"w{i}" for i in range(1, 15)]
    rows = [(1, " ".join([*w[:13], "X", *w[1:]])), (2, " ".join(w))]
    got = {r.doc_id: [tuple(f) for f in r.factors] for r in substring_dedup.relative_lz_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2] == [(0, 13, 1, 0), (1, 14, 1, 14)]  # the 14 words stand nowhere in a row
    rnd = random.Random(4)
    parts = [" ".join(rnd.choice("abcdefgh") for _ in range(30)) for _ in range(12)]
    rows = [(i, " ".join(rnd.choice([*parts, str(rnd.random())]) for _ in range(rnd.randint(0, 12)))) for i in range(200)]
    text = {i: t.split() for i, t in rows}
    out = substring_dedup.relative_lz_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert all(f.source < r.doc_id and text[r.doc_id][f.start : f.end] == text[f.source][f.place : f.place + f.end - f.start] for r in out for f in r.factors) and sum(len(r.factors) for r in out) > 100


def test_fingerprints(docs):
    sh = lambda t: (lambda w: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())(words(t))
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    rows = sorted(((i is not None, i or 0, t or "") for i, t in pairs(docs)))
    want = defaultdict(list)
    for n, (_, i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][2]
        e = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        want[i].append((len(t), hashlib.sha256(e.encode()).hexdigest(), like(sh(t), sh(e)), like(sh(t), sh(after))))
    got = defaultdict(list)
    for r in fingerprints.fingerprint_documents(docs).collect():
        got[r.doc_id or 0].append((r.n_chars, r.edited_sha256, r.near_edited, r.near_next))
    assert {i: sorted(x[:2] for x in v) for i, v in got.items()} == {i: sorted(x[:2] for x in v) for i, v in want.items()}
    assert all(abs(a - b) < 0.2 for i in want for x, y in zip(sorted(got[i]), sorted(want[i]), strict=True) for a, b in zip(x[2:], y[2:], strict=True))
    assert fingerprints.fingerprint_documents(empty(docs)).count() == 0


def test_sketches_merge(spark):
    d = spark.range(1).select(F.expr("transform(sequence(1, 1000), x -> xxhash64(x))").alias("h"))
    a = d.select(fingerprints.sketch("h").alias("a"), fingerprints.merge(fingerprints.sketch("h"), fingerprints.sketch("h")).alias("b"), "h")
    assert a.filter("a = b").count() == 1
    assert abs(a.select(fingerprints.distinct_shingles(F.col("a"))).first()[0] - 996) < 250


def test_substring_dedup(docs):
    rows = sorted(((i if i is not None else 1 << 62, t) for i, t in pairs(docs)), key=lambda x: x[0])
    first = {}
    for i, t in rows:
        for k in range(len(words(t)) - 12):
            first.setdefault(tuple(words(t)[k : k + 13]), i)
    want = Counter()
    for i, t in rows:
        w = words(t)
        gone = {p for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone).decode() if gone else t
        want[i, len(w), len(gone), kept] += 1
    got = Counter((r.doc_id if r.doc_id is not None else 1 << 62, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.relative_lz_dedup(docs).collect())
    assert got == want
    out = substring_dedup.relative_lz_dedup(docs, carry=docs.columns)
    assert out.columns[: len(docs.columns)] == docs.columns and "n_words_" in out.columns and out.count() == docs.count()
    assert substring_dedup.relative_lz_dedup(empty(docs)).count() == 0


PAGE = '<html><head><title>x</title><script>var t="</p>";</script></head><body><nav><a href="/">home</a></nav><div class="ad">buy</div><article><h1>{0} &amp; co</h1><p><b>first  {0}<br>line<p>second</p><div class="sharebox"><span>tell a friend</span></div><ul><li>one<li>two</ul><aside>by the way</aside></article><section class="comments"><p>hm</p></section><footer>f</footer>'


def test_html(spark):
    rows = [(i, "http://h.example/x" if i < 8 else f"http://o{i}.example/", PAGE.format(i)) for i in range(10)]
    rows += [(20, None, None), (21, "nonsense", "plain &lt;text&gt;"), (22, "http://q.example", "<p>a<p>b<"), (23, "http://q.example", "<div>" * 3000 + "deep" + "</div>" * 3000), (0, rows[0][1], rows[0][2])]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").transform(clash)
    got = {r.page_id: r.text for r in html_extract.extract_main_text(d).collect()}
    assert got[3] == "3 & co\nfirst 3 line\nsecond\none\ntwo"  # the share box is this host's template
    assert got[9] == "9 & co\nfirst 9 line\nsecond\ntell a friend\none\ntwo"
    assert (got[20], got[21], got[22], got[23]) == ("", "plain <text>", "a\nb<", "deep")
    assert html_extract.extract_main_text(empty(d)).count() == 0


def test_copied_articles_are_no_template(spark):
    rows = [(i, "http://h.example/", "<article><p>the same words</p></article>") for i in range(30)]
    assert {r.text for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()} == {"the same words"}


def test_copied_pages_without_article_are_no_template(spark):
    page = '<body><div class="box">site</div><div class="text">{0}</div></body>'
    copy = '<p>the same words</p><p class="x">and more</p>'
    rows = [(i, "http://h.example/", page.format(copy if i < 20 else f"<p>page {i}</p>")) for i in range(40)]
    rows += [(i, "http://c.example/", f'<body><div class="text">{copy}</div></body>') for i in range(40, 48)]
    got = {r.page_id: r.text for r in html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "the same words\nand more" if i < 20 or i >= 40 else f"page {i}" for i in range(48)}


def test_html_below_depth_200():
    deep, end = "<div>" * 300, "</div>" * 300
    assert html_extract.main_text(html_extract.parse(f"{deep}<p>one<p>two <b>and</b><br>half</p>{end}<p>three")) == "one\ntwo and half\nthree"
    root = html_extract.parse(f"before{deep}<article><h1>a</h1><p>b</p></article>{end}after" + "<i>" * 5000)
    assert html_extract.main_text(root) == html_extract.main_text(root, {1}) == "a\nb"
    box = html_extract.parse(f"{deep}<article><p>b</p><section x=1>box</section></article>")
    assert html_extract.main_text(box, set(html_extract.subtree_hashes(html_extract.parse("<article><section x=1>box</section></article>")).values())) == "b"


@pytest.mark.parametrize(
    ("inner", "text"),
    [
        ('<h2 id="navigation">Navigation of ships</h2><p>x</p>', "Navigation of ships\nx"),
        ('<div class="related-work"><p>earlier work</p></div>', "earlier work"),
        ('<section id="social-history"><p>of a town</p></section>', "of a town"),
        ("<header><h1>Title</h1><nav>home</nav></header><p>x</p>", "Title\nx"),
        ('<p>x</p><div class="related"><a href="/1">one</a> <a href="/2">two</a></div>', "x"),
        ('<p>x</p><div class="related"><p>what is told here has no links at all</p></div>', "x\nwhat is told here has no links at all"),
        ('<p>x</p><section class="comments"><p>hm</p></section><div class="ad">buy</div>', "x"),
    ],
)
def test_names_inside_an_article_need_a_second_sign(inner, text):
    assert html_extract.main_text(html_extract.parse(f'<body><div class="related">outside</div><header>site</header><article>{inner}</article></body>')) == text


def test_html_comment_articles_and_misleading_classes():
    page = "<article><h1>T</h1><p>x</p><article class='comment'>first!</article></article><article class='comments'>yo</article>"
    assert html_extract.main_text(html_extract.parse(page)) == "T\nx"
    assert html_extract.main_text(html_extract.parse("<article class='share'><p>the only one</article>")) == "the only one"


@pytest.mark.parametrize("part", ["<a '", "<a '>'", "<!", "<i></b>", "<p><button><i><div>", "<a b", "<script>", "</script ", "<", "<ul><li><b>", "<a x= ", "<!--", "</ "])
def test_broken_html_takes_linear_time(part):
    import time

    began = time.time()
    root = html_extract.parse("<p>start</p>" + part * ((1 << 20) // len(part)))
    assert html_extract.main_text(root, {1}).startswith("start") and time.time() - began < 30


def test_cut_off_markup_goes():
    assert html_extract.main_text(html_extract.parse("<p>a<p>b</p><a href='x")) == "a\nb"
    assert html_extract.main_text(html_extract.parse('<p>good</p><a href="x>text</a><p>more</p> 1<2')) == "good\ntext\nmore\n1<2"


def test_templates_beyond_the_broadcast(spark):
    rows = [(i, f"http://h{i % 70}.example/", f"<div class=text><section x=1>site {i % 70}</section><p>page {i}</p></div>") for i in range(700)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = [html_extract.extract_main_text(d, broadcast_bytes=b) for b in (0, 8 << 20)]
    assert all({r.page_id: r.text for r in g.collect()} == {i: f"page {i}" for i in range(700)} for g in got)


def test_warc_long_payload(spark):
    big = "0123456789abcdef" * 300_000
    d = spark.createDataFrame([(1, "u", big), (2, "u", big), (3, "u", big + "x")], "page_id long, url string, html string")
    assert {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.warc_round_trip(d).collect()} == {1: (len(big), "revisit", 2), 2: (len(big), "response", None), 3: (len(big) + 1, "response", None)}


def test_warc(spark):
    big, other = "é" * 600, "x" * 1000
    rows = [(1, "u", big), (2, "u v\r\nw", big), (3, None, other), (4, "u", other), (5, "u", other), (6, "u", "small"), (7, "u", "small"), (8, "u", None), (None, "u", big), (9, "u", "x" * 999), (10, "u", "x" * 999)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").transform(clash)
    got = {r.page_id: tuple(r)[1:] for r in warc.warc_round_trip(d).collect()}
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    to = {1: 2, None: 2, 3: 5, 4: 5}
    assert got == {i: (len((h or "").encode()), sha(h), "revisit" if i in to else "response", to.get(i)) for i, _, h in rows}
    assert warc.warc_round_trip(empty(d)).count() == 0


def test_bpe(docs):
    want = Counter()
    for i, t in pairs(docs):
        ids = TIKTOKEN.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe_encode(docs).collect()) == want
    assert bpe_encode(empty(docs)).count() == 0


def test_bpe_random_pieces():
    bpe, rnd = ByteBpe.load(), random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "é", "ß", "'s", "'LL", "1", "²", "_", "-", "中", "\x1c", "\x85", "\xa0", "😀", "the", "ing", "ſ", "İ", "th", "er"]
    for _ in range(2000):
        s = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))
        assert bpe.encode(s) == TIKTOKEN.encode_ordinary(s) and bpe.decode(bpe.encode(s)) == s.encode()
    for s in ("a" * 20_000, "ab" * 9_000, "".join(rnd.choice("abcdefghijk") for _ in range(20_000))):
        assert bpe.encode(s) == TIKTOKEN.encode_ordinary(s)


def test_decontaminate(spark, docs):
    rows = pairs(docs)
    long = " ".join(f"w{i}" for i in range(20_000))
    items = [(1, " ".join(w.decode() for w in words(rows[3][1])[:30])), (2, "TWO, Words!"), (3, None), (4, "..."), (5, "w777 w778 w779 w780 w781 w782"), (6, "w1 w2 w3 w4 w5 nothing of this is there"), (5, "w777 w778 w779 w780 w781 w782")]
    d = docs.select("doc_id", "text").union(spark.createDataFrame([(9999, long)], "doc_id long, text string"))
    norm = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    sh = lambda t, n: (lambda w: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)})(norm(t))
    want = Counter()
    for i, t in pairs(d):
        for j, q in items:
            own = sh(q, max(1, min(5, len(norm(q)))))
            if own and len(own & sh(t, max(1, min(5, len(norm(q)))))) >= 0.8 * len(own):
                want[i, j] += 1
    items = spark.createDataFrame(items, "item_id long, text string").withColumn("t", F.lit(0))
    for block in (decontaminate.BLOCK_BYTES, 64):
        assert Counter((r.doc_id, r.item_id) for r in decontaminate.contained_items(d, items, block_bytes=block).collect()) == want
    assert decontaminate.contained_items(empty(d), items).count() == decontaminate.contained_items(d, items.limit(0)).count() == 0


def test_rows_without_items(spark):
    rows = [(1, "nothing here"), (1, "it has one two three four five six inside"), (None, "ONE two, three four five six"), (None, None), (2, "one two")]
    d = spark.createDataFrame(rows, "doc_id long, text string").transform(clash)
    items = spark.createDataFrame([(7, "one two three four five six"), (8, "two"), (9, None)], "item_id long, text string")
    for block in (decontaminate.BLOCK_BYTES, 8):
        left = decontaminate.without_items(d, items, block_bytes=block)
        assert left.columns == d.columns and Counter((r.doc_id, r.text) for r in left.collect()) == Counter([rows[0], rows[3], rows[4]])
    assert decontaminate.without_items(d, items.limit(0)).count() == 5 and decontaminate.without_items(d.limit(0), items).count() == 0


def test_one_row_of_each(spark):
    a, b = (" ".join(f"{c}{i % 17}{i}" for i in range(60)) for c in "qz")
    rows = [(1, a), (1, b), (2, a), (None, b), (None, "only this one here"), (3, "only this one here"), (1, a)]
    d = spark.createDataFrame(rows, "doc_id long, text string").transform(clash)
    left = simhash.keep_one_of_each(d)
    assert left.columns == d.columns and Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(1, a), (1, b), (3, "only this one here")])
    assert simhash.keep_one_of_each(d.limit(0)).count() == 0


def brute_fingerprint(t):
    w = (t or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    ones = [sum(xxhash.xxh64_intdigest(x, 42) >> b & 1 for x in s) for b in range(64)] if len(s) < 5000 else None
    if ones is None:
        c = Counter(s)
        ones = [sum(n * (xxhash.xxh64_intdigest(x, 42) >> b & 1) for x, n in c.items()) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(s))


def brute_components(rows):
    f = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(f)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(f)):
        for j in range(i):
            if (f[i] ^ f[j]).bit_count() <= 3:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min((x for x in (least.get(find(i)), k) if x is not None), default=None)
    return [(f"{x:016x}", least[find(i)]) for i, x in enumerate(f)]


def test_simhash(docs):
    rows = pairs(docs)
    want = Counter((k, *c) for (k, _), c in zip(rows, brute_components(rows), strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_near_dups(docs).collect()) == want
    assert simhash.simhash_near_dups(empty(docs)).count() == 0


@pytest.mark.parametrize("bucket", [8, 4096])
def test_links_of_large_buckets(spark, bucket):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    f = np.unique(np.concatenate([base] + [base[:30] ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for _ in range(6)]))
    d = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    from skein.operators.graph import connected_components

    got = connected_components(simhash.link_fingerprints(d, bucket=bucket)).collect()
    label = {int(x): int(x) for x in f.view(np.int64)} | {r.node: r.component for r in got}
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 3
    reach = near.copy()
    for _ in range(8):
        reach = reach @ reach
    ids = f.view(np.int64)
    assert all((label[int(ids[i])] == label[int(ids[j])]) == reach[i, j] for i in range(len(f)) for j in range(len(f)))


def test_lm(docs):
    d = docs.filter("doc_id is not null")
    rows = pairs(d)
    tok = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(x for i, t in rows if not held(i) for x in tok(t))
    n, v = sum(c.values()), len(c)
    r = lm_scoring.lm_score(d, "crc32(cast(doc_id as string)) % 10 <> 0").collect()
    want = Counter((i, held(i), len(tok(t)), sum(c[x] > 0 for x in tok(t)), n, round(sum(log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tok(t)), 5)) for i, t in rows)
    assert Counter((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 5)) for x in r) == want
    assert sum(x.score for x in r) > sum(x.base_score for x in r) and all(x.score < 0 for x in r)
    assert lm_scoring.lm_score(empty(docs)).count() == 0 and lm_scoring.lm_score(docs, "false").first().train_tokens == 0


def brute_lm(rows, held):
    """Witten-Bell score of each row, a bigram's count as a filter of exact counts over the whole corpus gives it."""
    tok = lambda t: [*(t or "").encode().lower().split(), None]
    c, pair, after = Counter(), Counter(), defaultdict(set)
    for i, t in rows:
        if not held(i):
            w = tok(t)
            c.update(w)
            pair.update(zip([None, *w], w, strict=False))
            for a, b in zip([None, *w], w, strict=False):
                after[a].add(b)
    n, v = sum(c.values()), len(c)
    every = {x for i, t in rows for x in tok(t)}
    h = {x: lm_scoring.END if x is None else lm_scoring.all_words(pa.array([x.decode()]), lm_scoring.SPACE, lm_scoring.LOWER)[0][0] for x in every}
    asked = sorted({p for i, t in rows for p in zip([None, *tok(t)], tok(t), strict=False)}, key=str)
    keys = lm_scoring.mix(np.array([h[a] for a, _ in asked], np.uint64) + np.array([h[b] for _, b in asked], np.uint64) * lm_scoring._SECOND)
    hot = np.array([c[a] * lm_scoring.BUCKETS > n for a, _ in asked])
    bucket = lm_scoring.shard(np.where(hot, keys, np.array([h[a] for a, _ in asked], np.uint64)), lm_scoring.BUCKETS)
    count = np.array([pair[p] for p in asked])
    found = np.zeros(len(asked), np.int64)
    for b in range(lm_scoring.BUCKETS):
        own = bucket == b
        learned = own & (count > 0)
        level = lm_scoring.levels(count[learned])
        segment = lm_scoring.LogFrequencyBloom(1, lm_scoring.BITS_A_KEY * int(level.sum()))
        segment.add(0, keys[learned], level, 1)
        found[own] = segment.level(np.zeros(own.sum(), np.int64), keys[own], 1)
    least = dict(zip(asked, lm_scoring.least_count(found).tolist(), strict=True))

    def p(a, b):
        p0 = (c[b] + 0.1) / (n + 0.1 * (v + 1))
        return (min(least[a, b], c[a]) + len(after[a]) * p0) / (c[a] + len(after[a])) if c[a] else p0

    return {i: sum(log10(p(a, b)) for a, b in zip([None, *tok(t)], tok(t), strict=False)) for i, t in rows}


def test_lm_scores_are_those_of_the_rows_alone(spark):
    rnd = random.Random(9)
    d = spark.createDataFrame([(i, " ".join(f"w{int(rnd.paretovariate(0.7))}" for _ in range(rnd.randint(0, 200)))) for i in range(400)], "doc_id long, text string")
    had, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n, parts in ((3, 2), (37, 7), (200, 1)):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got.append(sorted(map(tuple, lm_scoring.lm_score(d.repartition(parts), "doc_id % 5 <> 0").collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)
    assert got[0] == got[1] == got[2]


@pytest.mark.parametrize("distinct", [False, True])
def test_lm_counts_every_bigram(spark, tmp_path, distinct):
    rnd = random.Random(8)
    rows = [(i, " ".join(f"a{j} b{j}" for j in range(i % 500 * 80, (i % 500 + 1) * 80)) if distinct else " ".join(f"w{int(rnd.paretovariate(0.6))}" for _ in range(rnd.randint(0, 60)))) for i in range(1000)]
    want = brute_lm(rows, lambda i: zlib.crc32(str(i).encode()) % 10 == 0)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents")
    got = {r.doc_id: r.score for r in lm_scoring.lm_score(spark.read.parquet(f"{tmp_path}/documents"), "crc32(cast(doc_id as string)) % 10 <> 0").collect()}
    assert len(got) == len(rows) and all(abs(got[i] - want[i]) < 1e-6 for i in want)


def test_bloom_holds_its_levels():
    b = lm_scoring.LogFrequencyBloom(4, 1 << 16)
    keys, level = np.arange(500, dtype=np.uint64), np.arange(500) % 5 + 1
    for s in range(4):
        b.add(s, keys[keys % 4 == s], level[keys % 4 == s], 1)
    got = b.level((keys % 4).astype(np.int64), keys, 1)
    assert (got >= level).all() and (got == level).mean() > 0.9 and (b.level((keys % 4).astype(np.int64), keys + 10_000, 1) == 0).mean() > 0.9


def test_pipeline(spark, tmp_path, docs):
    """With null and clashing ids, repeated rows, clashing columns; against brute force, ids of tokens included."""
    base = [(i, t) for i, t in pairs(docs) if i is not None]
    item = next(t for _, t in sorted(base, key=str) if t and len(t) > 200)
    rows = base + [(None, f"{item} and more"), (None, "a text without an id that nothing else is like at all"), (base[0][0], "another text under an id that is taken by a different one"), base[1]]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long")).transform(clash)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    item = " ".join(item.split()[:25])
    spark.createDataFrame([(1, item), (2, "the")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    # a document's place: rows without an id come last
    left = [((i is None, i or 0, n), t) for n, (i, t) in enumerate(rows) if t and any(ch.isalpha() for ch in t)]
    left = [(k, t) for (k, t), (_, c) in zip(left, brute_components(left), strict=True) if k == c]
    left = [(k[1] if not k[0] else 1 << 62, t) for k, t in left]
    first = {}
    for i, t in sorted(left, key=lambda x: x[0]):
        for k in range(len(words(t)) - 12):
            first.setdefault(tuple(words(t)[k : k + 13]), i)
    want, q = Counter(), decontaminate.shingles(item, 5)
    for i, t in left:
        w = words(t)
        gone = {p for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone).decode() if gone else t
        if len(q & decontaminate.shingles(kept, 5)) < 0.8 * len(q):
            ids = TIKTOKEN.encode_ordinary(kept)
            want[i if i < 1 << 62 else None, tuple(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()] += 1
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.ids_sha256) for r in got) == want and sum(want.values()) < len(left)


def test_pipeline_of_nothing(spark, tmp_path, docs):
    d = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(0).cast("long").alias("n_chars")).limit(0)
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_kept_text_without_places(docs):
    full, short = (substring_dedup.relative_lz_dedup(docs, locate=x) for x in (True, False))
    text = lambda df: Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in df.collect())
    assert text(full) == text(short) and short.filter("factors is not null").isEmpty() and not full.filter("size(factors) > 0").isEmpty()
