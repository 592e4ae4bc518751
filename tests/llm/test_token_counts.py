from __future__ import annotations

import pytest

from clinlake.llm.token_counts import MergeTable, TokenCounter, count_tokens
from tests.llm.helpers import DOCUMENTS, documents

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")

AWKWARD = [
    "<|endoftext|>abc <|startoftext|>", "ΑΣ Σ ΟΔΟΣ", "İstanbul ǅ ß ﬁ", "a b c\x1cd\x85e", "é é ñ", "aaaaaaaaaaaaaaaa a",
    "Don't we'll I'VE", "１２３ ½ x²", "日本語 テキスト", "😀😃 👩‍👩‍👧", "", "   ", "!!!???...", "\x00\x01", "<|ENDOFTEXT|>",
    "hello<|endoftext|><|endoftext|>world", "قلب हिन्दी", "x" * 5000, "ab" * 3000, "the " * 3000,
]


def test_counts_equal_the_library(spark):
    library = tokenizers.Tokenizer.from_file(PATH)
    texts = AWKWARD + [r[1] or "" for r in DOCUMENTS]
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert TokenCounter(MergeTable(PATH))(texts) == want


def test_a_small_memory_gives_the_same(spark):
    counter = TokenCounter(MergeTable(PATH), remembered=1)
    assert [counter([t])[0] for t in AWKWARD] == TokenCounter(MergeTable(PATH))(AWKWARD)


def test_rows_of_every_kind(spark):
    found = count_tokens(documents(spark), PATH).collect()
    assert len(found) == len(DOCUMENTS)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[3]["n_bytes"] == 0 and by_id[3]["n_tokens"] == 0 and not by_id[3]["over_limit"]
    assert by_id[8]["over_limit"] and by_id[7]["n_bytes"] == len(dict((r[0], r[1]) for r in DOCUMENTS)[7].encode())
    assert sum(r["doc_id"] == 2 for r in found) == 2 and None in by_id


def test_empty_table(spark):
    assert count_tokens(documents(spark, []), PATH).collect() == []
