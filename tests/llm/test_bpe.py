import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from braidwork.llm import bpe  # noqa: E402
from braidwork.llm.bpe import TextEncoder, bpe_digests, decode, encode, pieces  # noqa: E402

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def odd_texts():
    rng = random.Random(8)
    pool = "abcdefghijklmnopqrstuvwxyz" * 3 + "AEISTLM'’ \n\t.,!?#$%-_<>|&*0123456789éèßñÜŒİıΣσςЖ¼Ⅳ一二日本語한กअ́​　\x1c\x85 😀ﬁ"
    out = ["".join(rng.choice(pool) for _ in range(rng.randrange(150))) for _ in range(400)]
    out += ["".join(rng.choice("aeinostrhl") for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    return [*out, *["a" * k for k in range(40)], "<|endoftext|>x <|startoftext|><|endoftext|>", "it's I'll 'sss", " ", "", None]


def test_matches_the_library(library):
    texts = odd_texts()
    assert list(TextEncoder(PATH, cache_words=50).rows(texts)) == [expected(library, t) for t in texts]


def same_ids(library, texts):
    rows = [(n, h) for n, h, _ in TextEncoder(PATH).rows(texts)]
    coded = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert rows == [(len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()) for ids in coded]


def test_every_code_point(library):
    # All of the planes with letters; of the empty and private ones every 16th.
    every = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and (c < 0x34000 or 0xE0000 <= c < 0xE1000 or c % 16 == 0)]
    same_ids(library, [" ".join(f"a{c}b A{c}'s" for c in every[k : k + 256]) for k in range(0, len(every), 256)])


def test_random_strings(library):
    rng = random.Random(11)
    pool = [chr(c) for c in range(32, 0x20000) if chr(c).isprintable()] + list("aAbBsStT'' \u1e47\u0307\u0301\u0130\u03a3각") * 600
    same_ids(library, [" ".join("".join(rng.choice(pool) for _ in range(12)) for _ in range(50)) for _ in range(2000)])


def test_query(spark, library):
    from braidwork.llm.queries import op4_bpe

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op4_bpe(spark, folder).collect()}
    assert got == {k: expected(library, t) for k, t in texts.items()}


def test_long_texts(library):
    text = "The quick brown fox\n" * 60_000 + "x" * 5000
    assert "".join(pieces(text, 1000)) == text
    assert list(TextEncoder(PATH).rows([text, "a"])) == [expected(library, text), expected(library, "a")]


def test_frames(spark, make_docs, library):
    docs = make_docs([(1, "Hello, World!"), (1, "Hello, World!"), (2, None), (None, "naïve"), (3, "")])
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_digests(docs, PATH).collect())
    texts = {"1": "Hello, World!", "2": "", "None": "naïve", "3": ""}
    assert got == sorted((k, *expected(library, texts[k])) for k in ("1", "1", "2", "None", "3"))
    coded = encode(docs, PATH)
    ids = {r.doc_id: r.ids for r in coded.collect()}
    assert ids[1] == library.encode(texts["1"], add_special_tokens=False).ids
    assert {r.doc_id: r.text for r in decode(coded, PATH).collect()}[1] == library.decode(ids[1], skip_special_tokens=False)
    assert bpe_digests(make_docs([]), PATH).count() == 0
    assert bpe.byte_alphabet()[0] == "Ā"
