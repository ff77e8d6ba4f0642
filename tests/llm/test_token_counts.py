import random

import public_tokenizers
import pytest
from llm_helpers import EDGES, prose
from tokenizers import Tokenizer

from adlens.llm.token_counts import Splitter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [*EDGES, "don't we're I'LL 's ''s x'd", "  two  spaces \n\n tabs\t\tend  ", "a<|endoftext|>b <|endoftext|><|endoftext|>",
         "<|endoftext|>", "<|endoftext", "1234 ⅷ ² ½ x² ٣٤", "a՘b₏ c", "ᛪ0 \U00016ea0 new letter", "\x1c\x1f\x85\xa0  x　y",
         "é combining", "\x00 nul", "don’t", "a" * 5000, " " * 3000, "!?" * 900]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    return sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in rows), key=repr)


@pytest.mark.parametrize("head", [1, 50, 300_000])
def test_equals_the_library(spark, docs, library, head):
    rng = random.Random(11)
    rows = list(enumerate(TEXTS)) + [(500 + i, prose(rng, rng.randrange(0, 80))) for i in range(80)] + [(None, "no id"), (3, "again"), (3, "again")]
    out = token_counts(docs(rows), PATH, head=head).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in out), key=repr) == expected(library, rows)
    assert all(r.over_limit == (r.n_tokens > 1024) for r in out)


def test_pieces_equal_the_librarys_for_every_kind_of_character(library):
    with open(PATH, encoding="utf-8") as f:
        split = Splitter(f.read())
    rng = random.Random(12)
    for _ in range(400):
        top = rng.choice([0x7f, 0xff, 0x2fff, 0x1ffff])
        text = "".join(chr(c) for c in (rng.randrange(top) for _ in range(rng.randrange(30))) if not 0xd800 <= c < 0xe000)
        text = text.replace("\x21", " '").replace("\x22", "'s ")
        own = [text[i:j] for _, (i, j) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert split(text) == (0, own), repr(text)


CONTRACTIONS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"]


def test_contractions_after_everything_equal_the_librarys(library):
    """After a space, a mark, a letter, a digit and at the start; also as the head of a quoted word."""
    with open(PATH, encoding="utf-8") as f:
        split = Splitter(f.read())
    for c in CONTRACTIONS:
        for before in ["", " ", "  ", "\n", "\xa0", "dogs ", "dogs", "1", "1 ", "²", "(", " (", "'", " '", "é", "é ", "漢 "]:
            for after in ["", "he", " end", "!", "'", "1", "é", "’", "\n", "漢"]:
                for form in (c, c.upper()):
                    text = before + form + after
                    own = [text[i:j] for _, (i, j) in library.pre_tokenizer.pre_tokenize_str(text)]
                    assert split(text) == (0, own), repr(text)


@pytest.mark.parametrize("alphabet", [" 'stmdrevl", " 'sm²é1\n", " 'tx!漢\xa0"])
def test_short_random_strings_equal_the_librarys(library, alphabet):
    with open(PATH, encoding="utf-8") as f:
        split = Splitter(f.read())
    rng = random.Random(13)
    for _ in range(8000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(1, 12)))
        own = [text[i:j] for _, (i, j) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert split(text) == (0, own), repr(text)


def test_quoted_words_count_as_the_library_counts(spark, docs, library):
    rows = list(enumerate(["he said 'the dog' ran", "the 'more' of it", "it 'really' is", "dogs 's", " 'tis", "a 'd b 'll c 're"]))
    out = token_counts(docs(rows), PATH).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens) for r in out) == expected(library, rows)


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        Splitter(f.read())


def test_empty_table(spark, docs):
    assert token_counts(docs([]), PATH).collect() == []
