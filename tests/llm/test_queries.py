"""Every registered query of the subpackage on whole small tables: against its SQL, or against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser
from math import log10

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from skein.llm import decontaminate, queries
from tests.llm.test_llm import TIKTOKEN, brute_components, brute_lm, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def docs(con):
    return con.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, con, name):
    r = con.execute(queries.ORACLES[name])
    cols = [d[0] for d in r.description]
    assert Counter(tuple(x[c] for c in cols) for x in rows(spark, name)) == Counter(r.fetchall())


def test_op1(spark, docs):
    assert {r.doc_id: r.n_tokens for r in rows(spark, "op1_token_counts")} == {i: len(TIKTOKEN.encode_ordinary(t or "")) for i, t, _ in docs}


def test_op2(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op2_language_id")}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= got[i].score <= 1 for i, _, _ in docs) and len(got) == len(docs)
    asked = [(got[i].lang_pred, lang) for i, t, lang in docs if got[i].held_out and lang and any(c.isalpha() for c in t or "")]
    assert sum(a == b for a, b in asked) > 0.9 * len(asked)
    assert all(got[i].lang_pred == "und" for i, t, _ in docs if not any(c.isalpha() for c in t or ""))


def test_op3(spark, docs):
    got = {r.doc_id: r for r in rows(spark, "op3_fingerprints")}
    texts = [t or "" for _, t, _ in docs]
    for n, (i, _, _) in enumerate(docs):
        t, after = texts[n], texts[(n + 1) % len(texts)]
        q = len(t) // 4
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest() and got[i].n_chars == len(t)
    by_text = defaultdict(set)
    for i, t, _ in docs:
        by_text[t or ""].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())


class Article(HTMLParser):
    """Text of the article, a line a block: an extractor that knows how these pages are made, and has no rules but that."""

    BLOCKS = {"h1", "p", "div", "li", "article"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.lines = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in self.BLOCKS:
            self.lines.append("")
        elif tag == "br" and self.inside:
            self.lines[-1] += " "

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.lines.append("")
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside:
            self.lines[-1] += data

    def text(self):
        return "\n".join(x for x in (" ".join(y.split()) for y in self.lines) if x)


def test_op5(spark, con):
    got = {r.page_id: r for r in rows(spark, "op5_html_extraction")}
    pages = con.execute("SELECT page_id, url, html FROM pages").fetchall()
    for i, url, html in pages:
        a = Article()
        a.feed(html or "")
        a.close()
        assert (got[i].text, got[i].n_chars, got[i].url) == (a.text(), len(a.text()), url)
    assert len(got) == len(pages)


def test_op7(spark, docs):
    got = {r.doc_id: tuple(r)[1:] for r in rows(spark, "op7_byte_bpe")}
    for i, t, _ in docs:
        ids = TIKTOKEN.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())


def test_op8(spark, con, docs):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    sets = [(i, decontaminate.shingles(t, 5)) for i, t, _ in docs]
    want = {(i, j) for j, q in items for own in [decontaminate.shingles(q, 5)] for i, s in sets if own and len(own & s) >= 0.8 * len(own) - 1e-9}
    got = [(r.doc_id, r.item_id) for r in rows(spark, "op8_decontamination")]
    assert set(got) == want and len(got) == len(want) > 0


def test_op9(spark, docs):
    want = {i: c for (i, _, _), c in zip(docs, brute_components([(i, t) for i, t, _ in docs]), strict=True)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows(spark, "op9_simhash")} == want


def test_op10(spark, docs):
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    tok = lambda t: [re.sub(rb"[A-Z]", lambda m: m[0].lower(), w) for w in words(t)] + [None]
    c = Counter(x for i, t, _ in docs if not held(i) for x in tok(t))
    n, v = sum(c.values()), len(c)
    score = brute_lm([(i, t) for i, t, _ in docs], held)
    got = {r.doc_id: r for r in rows(spark, "op10_lm_scoring")}
    for i, t, _ in docs:
        r, w = got[i], tok(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(c[x] > 0 for x in w), n)
        assert abs(r.base_score - sum(log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) < 1e-6 * len(w)
        assert abs(r.score - score[i]) < 1e-6 * len(w)


def test_op13(spark, docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: tuple(r)[1:] for r in rows(spark, "op13_sentencepiece")}
    for i, t, _ in docs:
        ids = sp.encode(t or "", add_eos=True)
        assert got[i] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
