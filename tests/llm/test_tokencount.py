"""Token counts against the library's own encoding of whole texts."""

from __future__ import annotations

import tracemalloc
from collections import Counter
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import pytest
from corpus_samples import frame, messy_rows, prose
from tokenizers import Tokenizer

from casestar.llm import tokencount

DEFINITION = public_tokenizers.path("byte_bpe_50k.json")


def plain(rows, limit=1024):
    library = Tokenizer.from_file(DEFINITION)
    found = Counter()
    for doc_id, text, *_ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        found[doc_id, len((text or "").encode()), n, n > limit] += 1
    return found


def counted(docs, **options):
    return Counter(map(tuple, tokencount.token_counts(docs, DEFINITION, **options).collect()))


ODD = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|>  <|endoftext|>x", "don't we'll I'M 's",
       "tab\t\t x\n\n\ny \r\n z  ", "     x　", "͸\U000323b0\U00031350 \U0001fae9!",
       "٣٤ Ⅷ ½ x²", "é ज़ क्ष ‍", "\x1c\x1f\x85 x", "𝒳𝓎 日本語テキスト", "<|endoftext", "\0 \0a"]


def test_messy_documents_with_and_without_a_head(spark, messy):
    wanted = plain(messy_rows())
    assert counted(messy) == wanted
    assert counted(messy, head_rows=0) == wanted
    assert counted(messy, head_rows=40, head_bytes=200) == wanted


def test_odd_characters_and_special_strings(spark):
    rows = [(i, text, "en", "a", 0) for i, text in enumerate(ODD)]
    assert counted(frame(spark, rows), limit=3) == plain(rows, limit=3)


def test_every_code_point_is_cut_as_the_library_cuts_it():
    splitter = tokencount.Splitter(open(DEFINITION, encoding="utf-8").read())
    for start in range(0, 0x110000, 0x800):
        chars = [chr(c) for c in range(start, start + 0x800) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c} {c}1" for c in chars)
        wanted = [text[a:b] for _, (a, b) in
                  splitter.library.pre_tokenizer.pre_tokenize_str(text)]
        assert splitter.cut(text) == (wanted, 0)


def test_a_third_of_the_rows_alike_and_one_very_long_text(spark):
    rows = [(i, prose(i % 3 and i, 40), "en", "a", 0) for i in range(600)]
    rows += [(None, prose(5, 60_000, 30_000), "en", "a", 0)] * 2
    assert counted(frame(spark, rows), head_rows=100) == plain(rows)


def test_empty_table_and_other_tokenizers(spark, nothing):
    assert tokencount.token_counts(nothing, DEFINITION).count() == 0
    with pytest.raises(ValueError):
        tokencount.token_counts(nothing, public_tokenizers.path("word_bpe_49k.json"))


class Captured:
    """Stands for a frame and keeps the function that its tasks would run."""

    def select(self, *_):
        return self

    groupBy = agg = select

    def mapInArrow(self, function, _):
        self.function = function
        return self


def test_the_first_pass_holds_few_strings(spark):
    def word(n):
        return "".join(chr(97 + n // 26 ** k % 26) for k in range(5))

    texts = [" " + " ".join(word((i * 40_000 + j) * 7919) for j in range(40_000))
             for i in range(16)]
    wanted = Counter(f" {w}" for text in texts for w in text.split())
    vocabulary = Captured()
    tokencount._vocabulary(
        vocabulary, SimpleNamespace(value=open(DEFINITION, encoding="utf-8").read()))
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = vocabulary.function(iter([batch]))
    tracemalloc.start()
    try:
        handed = [next(parts)]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    found = Counter()
    for part in [*handed, *parts]:
        for pre, freq in zip(part["pre"].to_pylist(), part["freq"].to_pylist()):
            found[pre] += freq
    assert found == wanted
    assert most < 24 << 20
