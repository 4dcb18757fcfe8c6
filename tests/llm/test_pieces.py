import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from crewlens.llm import pieces
from crewlens.llm.common import table
from tests.llm import brute

SCHEMA = "doc_id long, text string"
ODD = [
    None, "", " ", "  ", "\n", "\n\n \n", " a", "a ", "a  b   c", "▁", "a▁b ▁ ▁▁x", "\t\r\x0b", "\x00a\x00", "日本語テキスト 한국어",
    "😀👍🏽 x", "<s> </s> <unk> <0x41>", "ﬁ Å① é", "a" * 500, "ab" * 3000, "word " * 3000, "supercalifragilisticexpialidocious" * 30,
    "The quick brown fox.\nJumps over\t the lazy dog!", "\ufffd\ufeff\u200b\u00a0", "😀" * 100, " " * 300 + "x" + " " * 40,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def expected(library, text):
    ids = library.encode(text or "", add_eos=True)
    return ids, library.decode(ids)


def random_texts(n):
    rng = random.Random(3)
    signs = "abcdefghijklmnopqrstuvwxyzABCDEF    \n\t.,;-éüßñç▁日本😀0123456789\u00a0"
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(400))) for _ in range(n)]


def test_equals_the_library(make, library):
    texts = ODD + random_texts(200)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x"), (3, texts[3])]
    got = pieces.encode(make(SCHEMA, rows).repartition(3), "doc_id", ids=True).collect()
    assert len(got) == len(rows)
    for r in got:
        ids, decoded = expected(library, "x" if r.doc_id is None else texts[r.doc_id])
        assert (r.token_ids, r.decoded) == (ids, decoded)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == brute.sha(decoded)


def test_whole_table_equals_the_library(spark, library):
    df = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in pieces.encode(df, "doc_id").collect():
        ids, decoded = expected(library, texts[r.doc_id])
        assert (r.ids_sha256, r.decoded_sha256) == (brute.sha(" ".join(map(str, ids))), brute.sha(decoded))


def test_both_agendas_agree():
    own = pieces.pieces(pieces.MODEL)
    rng = random.Random(9)
    for width in (2, 3, 7, 20, 48):
        some = ["▁" + "".join(rng.choice("abcdeinorst▁é日") for _ in range(width - 1)) for _ in range(50)]
        assert own.together(some) == [own.agenda(s) for s in some]


def test_symbol_numbers_give_the_ids_of_the_agenda(monkeypatch):
    """Segments of one length, with and without foreign characters, and forgotten in between."""
    own = pieces.Pieces(public_tokenizers.path(pieces.MODEL))
    monkeypatch.setattr(pieces, "REMEMBERED", 60)
    rng = random.Random(4)
    for width in (1, 2, 5, 30, 49):
        some = {"▁" + "".join(rng.choice("abcdeinorst▁é日😀") for _ in range(width - 1)) for _ in range(50)}
        own.learn(some)
        assert len(own.ids) <= 60 and own.ids.keys() == own.raw.keys() and some <= own.ids.keys()
        for s in some:
            coded = [own._coded(p) for p in own.agenda(s)]
            assert (own.ids[s], own.raw[s]) == ("".join(c[0] for c in coded), b"".join(c[1] for c in coded))


def test_empty_and_clashing_columns(make):
    assert pieces.encode(make(SCHEMA, []), "doc_id").collect() == []
    df = make(SCHEMA, [(1, "hi")]).withColumn("k0", F.lit("x")).withColumn("n_tokens", F.lit(9))
    assert pieces.encode(df, "doc_id").first().n_tokens == 2
