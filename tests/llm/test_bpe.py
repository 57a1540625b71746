import hashlib
import random
import sys

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fathomline.llm import bpe
from fathomline.llm.catalog import QUERIES
from tests.llm import helpers


def library():
    tokenizer = Tokenizer.from_file(bpe.word_vocabulary())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def check(texts):
    tokenizer = library()
    ids, decoded = bpe.Encoder(bpe.word_vocabulary(), max_words=500)(texts)
    for text, own, plain, want in zip(texts, ids, decoded, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(own, dtype=np.int32).tolist() == want.ids, text[:80]
        assert plain == tokenizer.decode(want.ids, skip_special_tokens=False)


def test_odd_texts():
    check(["", "  ", "Σ ΑΣ ΣΑΣ.", "it's WE'LL I'd a<|endoftext|>B <|startoftext|>", "aaaa" * 500, "é ́x", "İI",
           "<|EndOfText|>", "\x1cab\x1d c\x1e", "\x00\x7f", "1234 ½", "don't'stop", "a​b", "﻿x",
           "<|endoftext|><|endoftext|>", "x" * 20_000, "éé  　 😀👍🏽"])


def test_all_code_points():
    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    check(["".join(f" a{c}b{c}" for c in every[i:i + 64]) for i in range(0, len(every), 64)])


def test_new_characters_compose_as_in_the_library():
    check(["\U00016121\U0001611e", "x\u1c89y\u1c8a", "a\U00011383\U000113c9", "\U000105d2\u0307 é", "\ua7cb\ua7cc\ua7da"])


def test_random_texts():
    pick = random.Random(0)
    check(["".join(pick.choice("abcdehilnorst'0 <|>.é́ßÑ😀") for _ in range(pick.randint(1, 60))) for _ in range(3_000)])


def test_query(spark):
    tokenizer = library()
    got = {r.doc_id: r for r in QUERIES["op5_bpe"](spark, helpers.FOLDER).collect()}
    for doc_id, text, *_ in helpers.documents():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        r = got[doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_odd_rows(spark):
    odd = helpers.odd(spark).withColumn("decoded", F.lit(1))
    rows = bpe.encode(odd, bpe.word_vocabulary()).collect()
    assert len(rows) == odd.count()
    assert all(r.n_tokens == len(r.token_ids) for r in rows)
    assert {r.n_tokens for r in rows if not (r.text or "").strip()} == {0}
    assert bpe.encode(helpers.empty(spark), bpe.word_vocabulary()).count() == 0
