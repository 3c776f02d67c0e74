import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from auditflow.llm.bpe import encoder
from auditflow.llm.token_counts import token_counts

from .conftest import LONG

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "é ", "\n", "\t ", "'s", "'ll", " the", "don't", "12", "٣", "漢字", "😀", "<|endoftext|>", "<|end", "　", "\x85", "x.", "!!"]


def texts(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randrange(30))) for _ in range(n)]


def test_every_prefix_has_the_librarys_count():
    library, ours = Tokenizer.from_file(PATH), encoder(PATH)
    for text in texts(150, 1):
        found = ours.prefixes(text)
        assert found.total == len(library.encode(text, add_special_tokens=False).ids)
        for cut in range(len(text) + 1):
            assert found.at(cut) == len(library.encode(text[:cut], add_special_tokens=False).ids), (text, cut)


def test_what_fits_a_limit_is_whole_and_no_longer_than_it():
    ours = encoder(PATH)
    for text in texts(100, 2):
        found = ours.prefixes(text)
        cut = found.fit(5)
        assert found.at(cut) <= 5 or text[:cut] != text
        assert cut == len(text) or found.counts[[*found.ends()].index(cut) + 1] > 5


def test_odd_rows(docs):
    df = docs((1, None), (2, ""), (None, "a b"), (3, LONG), (3, LONG), (4, "é" * 5000))
    got = df.select("doc_id", token_counts(F.col("text"), limit=4).alias("c")).select("doc_id", "c.*").collect()
    library = Tokenizer.from_file(PATH)
    expected = [len(library.encode(t or "", add_special_tokens=False).ids) for t in (None, "", "a b", LONG, LONG, "é" * 5000)]
    assert [r.n_tokens for r in got] == expected
    assert got[2].fit_chars == 3 and got[0].fit_chars == 0 and got[3].fit_chars == len("word word word word")


def test_empty_table(docs):
    assert docs().select(token_counts(F.col("text"))).count() == 0
