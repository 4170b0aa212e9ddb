"""The word encoder of the packing operator, and the batches that Python tasks get."""

import random
import string

import numpy as np
import pyarrow as pa
import pytest

from tabulyst.llm import packing
from tabulyst.llm.common import BATCH_ROWS, ship, tokenizer_file


@pytest.fixture(scope="module")
def vocabulary():
    with open(tokenizer_file("word_bpe_49k.json"), "rb") as f:
        return f.read()


def _by_library(encoder, text):
    return np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_a_word_is_merged_once_whatever_stands_around_it(vocabulary):
    encoder = packing.WordEncoder(vocabulary)
    marks = [c for c in string.punctuation if c != "'"]
    text = " ".join(f"{a}{w}{b}" for a in marks for b in marks for w in ("Word", "word", "WORD"))
    encoder.memo.clear()
    assert encoder([text])[0] == _by_library(encoder, text)
    assert len(encoder.memo) < 100  # not one for each of 2,883 parts


def test_ids_are_the_librarys(vocabulary):
    encoder, pick = packing.WordEncoder(vocabulary), random.Random(5)
    assert encoder.apart
    latin = [chr(i) for i in range(256)]
    alphabets = [latin, "'strevemld S\n1a", [*latin, *"ΣαЖ漢—’́"]]
    texts = ["", " ", "'", "a''s's'rex've 'll'd'm't", "<|endoftext|> x y", "é<|startoftext|>cd ’s"]
    texts += ["".join(pick.choices(pick.choice(alphabets), k=pick.randrange(40))) for _ in range(1500)]
    assert encoder(texts) == [_by_library(encoder, t) for t in texts]


def test_blocks_of_a_long_text_join_again(vocabulary, monkeypatch):
    encoder, pick = packing.WordEncoder(vocabulary), random.Random(6)
    text = "".join(pick.choices("abcé' .1\n", k=5000)) + "x" * 300 + " end"
    assert "".join(packing._blocks(text, 100)) == text
    whole = encoder([text, "a"])
    monkeypatch.setattr(packing._blocks, "__defaults__", (100,))
    monkeypatch.setattr(packing, "BLOCK", 100)
    assert encoder([text, "a"]) == whole == [_by_library(encoder, t) for t in (text, "a")]


def test_a_full_memo_is_emptied(vocabulary, monkeypatch):
    monkeypatch.setattr(packing, "MEMO_WORDS", 5)
    encoder = packing.WordEncoder(vocabulary)
    texts = ["one two three four", "five six seven eight nine ten", "one ten", "€ one €x €y €z €a €b"]
    for t in texts:
        assert encoder([t])[0] == _by_library(encoder, t)


def test_words_that_no_token_ends_are_merged_one_at_a_time(vocabulary):
    encoder = packing.WordEncoder(vocabulary)
    words = [b"one", "naïve".encode("latin-1"), b"--"]
    want = encoder._merged(words)
    encoder.last[:] = False
    assert encoder._merged(words) == want and all(want)


def test_python_tasks_get_small_batches(spark):
    ship(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    got = [r["n"] for r in spark.range(0, 3 * BATCH_ROWS, 1, 1).mapInArrow(sizes, "n long").collect()]
    assert sum(got) == 3 * BATCH_ROWS and max(got) <= BATCH_ROWS
