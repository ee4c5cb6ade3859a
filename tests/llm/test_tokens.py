import gc
import random
import weakref

import duckdb
import numpy as np
from tokenizers import Tokenizer

from rankdrift.llm import tokens
from rankdrift.llm.tokens import WordEncoder, vocabulary_path
from tests.llm.conftest import ODD_TEXTS, SF

WHOLE = Tokenizer.from_file(vocabulary_path())


def same(encoder, text):
    ids = WHOLE.encode(text or "", add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == ids


def test_words_give_the_ids_of_whole_texts():
    encoder = WordEncoder(remembered=50)  # so that it forgets
    for (text,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall():
        same(encoder, text)


def test_odd_texts():
    encoder = WordEncoder()
    for text in ODD_TEXTS:
        same(encoder, text)


def test_random_strings():
    encoder, pick = WordEncoder(), random.Random(3)
    letters = "aAbé ÉßÄ'.,!%\n\t\x1c  éİıǅ1²½ª<|>日\U0001f600-st"
    for _ in range(3000):
        same(encoder, "".join(pick.choices(letters, k=pick.randint(1, 30))))


def test_random_latin_strings():
    """Texts that are put in lower case, with commas and full stops set apart."""
    encoder, pick = WordEncoder(), random.Random(4)
    units = [*map(chr, range(256)), *"aZéÀ7²., '" * 20, ", ", ". ", "'s, ", ".,", "<|endoftext|>", "<|EndOfText|>", "it'S. "]
    for _ in range(3000):
        same(encoder, "".join(pick.choices(units, k=pick.randint(1, 30))))


def test_words_are_learnt_once_whatever_their_case_and_marks(monkeypatch):
    learnt, learn = [], tokens._Learner.learn
    monkeypatch.setattr(tokens._Learner, "learn", lambda self, chunk, memory: learnt.append(chunk) or learn(self, chunk, memory))
    text = "Été, ÉTÉ. été Word, word. WORD, wOrd"
    same(WordEncoder(), text)
    assert sorted(learnt) == sorted(c.encode() for c in ("été", "word", ",", "."))


def test_an_encoder_goes_with_its_last_reference():
    """A worker runs task after task, each with an encoder of its own, whose memory of chunks must not pile up."""
    gc.collect()
    gc.disable()
    try:
        encoder = WordEncoder()
        encoder.encode_document("some words, and more")
        memory = weakref.ref(encoder._ids.__self__)
        assert len(memory()) > 0
        del encoder
        assert memory() is None
    finally:
        gc.enable()
