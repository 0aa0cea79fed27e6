"""Spelling variants, collocations and SentencePiece: small cases, odd input, and brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from skein.llm import collocations, pieces, spelling

ROWS = [(1, "Alpha\tbeta  gamma, alpha beta gamma. Straße éclair\nalpha beta", "en"), (2, None, "en"), (3, "", None), (4, "one two three " * 40, None), (4, "one two three " * 40, None), (None, "x " * 5000, "de"), (5, "kaleidoscope " * 30 + "kaleidascope kaleidascope", "de")]


@pytest.fixture(scope="module")
def docs(spark):
    """Null ids, texts and languages, repeated rows, a long text, and columns whose names clash."""
    d = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    for c in ("word", "n", "size", "phrase", "a", "k", "t", "g", "chunk", "bucket", "n_tokens", "x.y"):
        d = d.withColumn(c, F.lit(7))
    return d


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute_variants(c, times=10):
    near = defaultdict(set)
    shapes = defaultdict(set)
    for w in c:
        for i in range(len(w)):
            shapes[w[:i], w[i + 1 :]].add(w)
            less = w[:i] + w[i + 1 :]
            if less in c:
                near[w].add(less)
                near[less].add(w)
    for g in shapes.values():
        for w in g:
            near[w] |= g - {w}
    form = {w: b for w in c if near[w] for b in [min(near[w], key=lambda x: (-c[x], x))] if c[b] >= times * c[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), c[w], len(near[w]), c[form[w]] if w in form else None) for w in c}


@pytest.mark.parametrize("block", [2, 7, 512])
def test_variants(spark, block, monkeypatch):
    """Dense words over few letters, so that blocks must be subdivided in Spark and in tasks; some far longer than others."""
    monkeypatch.setattr(spelling, "SCAN", 3)
    rnd = random.Random(block)
    c = {"".join(rnd.choice("abéÿ") for _ in range(rnd.randint(1, 9))): rnd.choice([1, 2, 15, 30, 400, 5000, 60000]) for _ in range(900)}
    long = "ab" * 300
    c |= {long: 500, long[:150] + "x" + long[150:]: 3, long[:-1]: 2, "b" + long: 1}
    words = spark.createDataFrame(list(c.items()), "word string, n long").withColumn("near", F.lit(1))
    got = [tuple(r) for r in spelling.spelling_variants(words, block=block).collect()]
    assert len(got) == len(c) and set(got) == brute_variants(c)
    if block < 512:
        rows = spelling.dictionaries(words, block).groupBy(*spelling.KEYS).count().filter("count > %d and upto - at > 1" % block)
        assert rows.isEmpty()


def test_words_of_a_corpus(spark, docs):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = Counter()
    for i, t, _ in ROWS:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            want[r[: h % len(r)] + r[h % len(r) + 1 :] if h % 31 == 0 else r] += 1
    got = {r.word: r.n for r in spelling.corpus_words(docs, least=3).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 3 and n >= 2} and len(got) > 3
    every = {r.word: r.n for r in spelling.corpus_words(docs, least=3, drop_one_in=1).collect()}
    assert sum(every.values()) < sum(got.values())  # all runs lose a character
    assert spelling.spelling_variants(spelling.corpus_words(docs)).filter("word = 'kaleidascope'").first().form == "kaleidoscope"


def test_variants_of_nothing(docs):
    assert spelling.spelling_variants(spelling.corpus_words(docs.limit(0))).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(spelling.corpus_words(docs), times=1)


def brute_phrases(rows, least):
    f = Counter()
    n = Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, t, lang in rows:
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", (t or "").translate(low)):
            w = re.findall("[^\\x20\\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang or "und", " ".join(w[i : i + k]), k] += 1
    return {(*x, a) for x, a in f.items() if a >= least} | {(g, None, 0, a) for g, a in n.items() if a}


@pytest.mark.parametrize("least", [1, 2, 30])
def test_frequent_phrases(docs, least):
    assert {tuple(r) for r in collocations.frequent_phrases(docs, least).collect()} == brute_phrases(ROWS, least)


def test_frequent_phrases_of_a_crowded_sketch(spark, monkeypatch):
    """Few cells and many chunks: what survives by mistake falls to its exact count, and nothing frequent is lost."""
    monkeypatch.setattr(collocations, "SEGMENT", 64)
    monkeypatch.setattr(collocations, "BYTES_A_CELL", 200)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 4000)
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice([f"w{int(rnd.paretovariate(0.6))}", "a b", "c,", "d\t e"]) for _ in range(rnd.randint(0, 120))), rnd.choice(["en", "de", None])) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = [tuple(r) for r in collocations.frequent_phrases(d, 30).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_phrases(rows, 30)


def test_collocations_of_huge_counts(spark):
    """Products beyond 64 bits, equal cuts, and subsumption by phrases that are dropped themselves."""
    big = 4_000_000_000_000_000_000
    rows = [("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "c", 1, big), ("en", "d", 1, big), ("en", "a b", 2, big - 1), ("en", "b c", 2, 5), ("en", "a b c", 3, 5), ("en", "a b c d", 4, 4), ("en", "b c d", 3, 4), ("en", "c d", 2, 100), ("en", None, 0, 3 * big // 2)]
    got = [tuple(r) for r in collocations.collocations(spark.createDataFrame(rows, "lang string, phrase string, k int, a long")).collect()]
    assert got[0] == ("en", 1, "a b", big - 1, big, big - 1, 3 * big // 2, 2000000 * (big - 1) // (2 * big - 1))
    assert [r[2] for r in got] == ["a b", "c d", "a b c d"] and got[1][3:6] == (100, big, big) and got[2][3:6] == (4, big, 4)


def test_collocations_of_nothing(docs):
    assert collocations.collocations(collocations.frequent_phrases(docs.limit(0))).count() == 0
    assert collocations.frequent_phrases(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_pieces_like_the_library(sp):
    bpe, rnd = pieces.encoder(), random.Random(5)
    vocabulary = [sp.id_to_piece(i) for i in range(259, 32000)]
    odd = [*"ab  ▁\n\t.,0é中文ß\x00퟿😀 　", "<s>", "</s>", "<0x0A>", " " * 17, " " * 5]
    for n in range(6000):
        text = ["".join(rnd.choice(odd) for _ in range(rnd.randrange(30))), "".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(8))).replace("▁", rnd.choice(" ▁")), "".join(rnd.choice("ettaoinshr  ") for _ in range(rnd.randrange(60)))][n % 3]
        ids = sp.encode(text, add_eos=True)
        assert bpe.encode(text) == ids and bpe.decode(ids) == sp.decode(ids)
        ids = [rnd.choice([rnd.randrange(32000), rnd.randrange(259), rnd.randrange(100, 259), 259]) for _ in range(rnd.randrange(8))]
        assert bpe.decode(ids) == sp.decode(ids)


def test_last_tokens_of_prefixes(sp):
    """Each prefix's last token is the last of its own encoding."""
    bpe = pieces.encoder()
    for word in ("▁internationalization", "▁Donaudampfschiff", "▁▁▁▁▁", "▁the"):
        last = bpe.last_tokens(word)
        assert last[0] == -1 and all(bpe.tokens[last[n]] == sp.encode(word[:n].replace("▁", " ")[1:], out_type=str)[-1] for n in range(2, len(word) + 1))


def test_pieces_of_a_table(docs, sp):
    got = Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in pieces.piece_encode(docs, keep_ids=True).collect())
    assert got == Counter((i, len(ids), tuple(ids)) for i, t, _ in ROWS for ids in [sp.encode(t or "", add_eos=True)])
    assert pieces.piece_encode(docs.limit(0)).count() == 0


def test_long_text_takes_linear_time(sp):
    for text in ("a" * 300_000, " " * 100_000, "中" * 100_000, "word " * 60_000):
        assert pieces.encoder().encode(text) == sp.encode(text, add_eos=True)


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        m = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    m.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        pieces.PieceBpe(m.SerializeToString())


def test_strings_of_phrases():
    table = pa.table({"g": ["x", "y"], "t": ["a\tb  c d", "A\tB. c"]})
    p = collocations.Phrases(table, "g", "t")
    got = set(zip(p.strings(pa.array(range(len(p.keys))).to_numpy()).to_pylist(), p.size.tolist(), strict=True))
    assert {("a b c d", 4), ("b c", 2), ("a b", 2), ("c", 1)} <= got and ("b c", 2) in got and len(p.keys) == 14
