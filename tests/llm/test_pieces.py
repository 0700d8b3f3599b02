import random
from pathlib import Path

import pytest
from sentencepiece import SentencePieceProcessor

from tenura.llm import pieces
from tenura.llm.queries import tokenizer_path
from llm.conftest import sha

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return pieces.Encoder(PATH), SentencePieceProcessor(model_file=PATH)


def ids(encoder, text):
    return pieces._as_ids(encoder.ids_text(text))


def test_like_the_library_on_random_and_odd_texts(both):
    encoder, library = both
    rng = random.Random(3)
    letters = "aeionrtsthe  \n\t▁é漢😀<0x41>ś.,!'\"12\r\x00﻿ "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(6000)]
    texts += [" " * i + "a" + " " * j + "the" for i in range(36) for j in range(36)]
    texts += [c * n for c in "a=- .\n▁é漢" for n in range(40)] + ["", "<s> </s> <unk> <0x0A> ▁x", "the" * 50, "x" * 3000]
    texts.append(Path(__file__).read_text())
    for text in texts:
        assert ids(encoder, text) == library.encode(text), text


def test_whole_texts_without_splitting_agree(both):
    encoder, library = both
    for text in ["a long  text with   spaces", "so many words, and 12345 numbers", "übergrößenträger naïve"] * 2:
        assert encoder.table.encode("▁" + text.replace(" ", "▁")) == library.encode(text)


def test_last_token_of_every_prefix_is_the_library_s(both):
    encoder, library = both
    text = "unbelievable antidisestablishmentarianism"
    for n in range(1, len(text) + 1):
        assert encoder.table.encode("▁" + text[:n].replace(" ", "▁"))[-1] == library.encode(text[:n])[-1]


def test_compatible_pairs_are_those_that_stay(both):
    table = both[0].table
    rng = random.Random(4)
    every = [i for i in table.piece if table.arising(i) and all(c in table.ids for c in table.piece[i])]
    for _ in range(4000):
        a, b = rng.choice(every), rng.choice(every)
        assert table.compatible(a, b) == (table.merged(table.piece[a] + table.piece[b])[0] == [a, b])


def test_digests_round_trip_nulls_empty_and_repeats(spark, docs_of, both):
    rows = [(1, "A text, with ünïcode 漢字"), (1, "A text, with ünïcode 漢字"), (None, "x"), (2, None), (3, ""), (4, "word " * 20_000)]
    out = pieces.digests(docs_of(rows, {"ids": "a", "n_tokens": "b"}), PATH).collect()
    want = []
    for d, t in rows:
        found = both[1].encode(t or "")
        want.append((d, len(found), sha(",".join(map(str, found))), sha(both[1].decode(found))))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    assert pieces.digests(docs_of([]), PATH).collect() == []


def test_encode_and_decode_tables(spark, docs_of):
    rows = [(1, "Round trip\n of  a text."), (2, None)]
    decoded = pieces.decode(pieces.encode(docs_of(rows), PATH), PATH).collect()
    assert sorted(map(tuple, decoded)) == [(1, rows[0][1]), (2, "")]


def test_sample_documents(spark, data_dir):
    from tenura.llm.queries import registered, table

    library = SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: tuple(r)[1:] for r in registered()["op7_sentencepiece"](spark, data_dir).collect()}
    for r in table(spark, data_dir, "documents").collect():
        found = library.encode(r.text)
        assert got[r.doc_id] == (len(found), sha(",".join(map(str, found))), sha(r.text))
