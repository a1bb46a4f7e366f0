"""Token counts of long and varied texts against the library, also where the compiled table must be dropped."""

import random

import numpy as np
import pyarrow as pa
import pytest

from stereobate.llm import tokencount
from stereobate.llm._text import flat
from stereobate.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def pieces(library, rng, size):
    out = []
    n = 0
    while n < size:
        piece = library.id_to_piece(rng.randrange(300, library.vocab_size())).replace("▁", " ")
        out.append(piece)
        n += len(piece)
    return "".join(out)


def counted(texts):
    t = tokencount.Transducer(tokencount.vocabulary(tokenizer_path("piece_bpe_32k.model")))
    return [int(x) for text in texts for x in t.counts(*flat(pa.array([text])))], t


def test_a_long_text_of_random_pieces(library):
    text = pieces(library, random.Random(1), 2_000_000)
    got, t = counted([text])
    assert got == [len(library.encode(text))]
    assert t.table.size <= tokencount.MOST_CELLS


def test_runs_of_spaces_of_every_length(library):
    texts = [f"{a}{' ' * n}{b}" for n in range(70) for a in ("", "x", ".") for b in ("", "the", "\n")]
    assert counted(texts)[0] == [len(library.encode(x)) for x in texts]


def test_parts_of_a_text_and_a_small_table(library, monkeypatch):
    """Parts cut anywhere and rows dropped at any step leave the counts as they are."""
    rng = random.Random(2)
    texts = [pieces(library, rng, 3000), "größer und größer " * 90, "a" * 700 + " " * 90 + "語彙😀" * 60, " lead", "x"]
    monkeypatch.setattr(tokencount, "BATCH_BYTES", 101)
    monkeypatch.setattr(tokencount, "CHUNK", 16)
    monkeypatch.setattr(tokencount, "MOST_CELLS", 1)
    monkeypatch.setattr(tokencount, "MOST_STATES", 50)
    got, t = counted(texts)
    assert got == [len(library.encode(x)) for x in texts]
    assert len(t.row_state) <= t.most_rows
    many = flat(pa.array(texts))
    assert list(t.counts(*many)) == got
    assert np.array_equal(t.counts(*flat(pa.array(["", "", ""]))), [0, 0, 0])
