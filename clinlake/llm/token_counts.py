"""Token counts by rank-synchronous merging of ragged arrays.

A batch's distinct pre-tokens become one flat array of symbol ids with a parallel
array of owners. In each round every pre-token finds its pair of lowest rank and
merges all its occurrences at once, until no pair is left; the surviving symbols
are counted. Pre-tokens that a worker has met are looked up in a bounded table.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import map_rows

#: Distinct pre-tokens a worker remembers before it starts anew.
REMEMBERED = 400_000
NO_RANK = np.iinfo(np.int32).max


def byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class MergeTable:
    """A byte-level BPE vocabulary with word ends, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        chars = byte_characters()
        self.inner = np.array([vocab[chars[b]] for b in range(256)], dtype=np.int64)
        self.final = np.array([vocab[chars[b] + suffix] for b in range(256)], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int32), made[order]
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # White space is the Unicode property here; other engines' \s takes in more control characters.
        self.pieces = regex.compile(split.replace(r"\s", r"\p{White_Space}"))

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special tokens stand in it."""
        parts = self.special.split(text) if self.special else [text]
        found: list[str] = []
        for part in parts:
            if not part.isascii():
                # Lower-casing goes character by character, so a final sigma has no form of its own.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            found += self.pieces.findall(part.lower())
        return found, len(parts) - 1

    def counts(self, tokens: list[str]) -> np.ndarray:
        """Symbols that survive in each pre-token once no pair can be merged."""
        encoded = [t.encode("utf-8", "surrogatepass") for t in tokens]
        sizes = np.array([len(b) for b in encoded], dtype=np.int64)
        result = np.zeros(len(tokens), dtype=np.int64)
        if not len(tokens):
            return result
        raw = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(sizes)[sizes > 0] - 1
        symbols[ends] = self.final[raw[ends]]
        owner = np.repeat(np.arange(len(tokens)), sizes)
        while len(symbols):
            pair = (symbols[:-1] << 32) | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            known = (self.keys[at] == pair) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.rank[at], NO_RANK), NO_RANK)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(owner))))
            done = best == NO_RANK
            if done.any():
                result += np.bincount(owner[done], minlength=len(tokens))
            chosen = (rank == best) & ~done
            # In a run like "aaa" the pairs overlap: from its left end, every other one is merged.
            place = np.arange(len(chosen))
            runs = np.maximum.accumulate(np.where(chosen & ~np.append(False, chosen[:-1]), place, 0))
            chosen &= (place - runs) % 2 == 0
            left = np.flatnonzero(chosen)
            symbols[left] = self.made[at[left]]
            keep = ~done
            keep[left + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return result


class TokenCounter:
    """Counts tokens of whole texts; remembers a bounded number of pre-tokens."""

    def __init__(self, table: MergeTable, remembered: int = REMEMBERED):
        self.table, self.remembered, self.known = table, remembered, {}

    def __call__(self, texts: list[str]) -> list[int]:
        split = [self.table.pre_tokens(t) for t in texts]
        if len(self.known) > self.remembered:
            self.known = {}
        new = [t for t in set().union(*(tokens for tokens, _ in split)) if t not in self.known]
        self.known.update(zip(new, self.table.counts(new).tolist(), strict=True))
        look = self.known.__getitem__
        return [sum(map(look, tokens)) + special for tokens, special in split]


def count_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """Bytes and tokens of every text: (id, n_bytes, n_tokens, over_limit).

    NULL texts count as empty: no bytes, no tokens. Special token strings inside a
    text count as one token each. Repeated rows and NULL ids are kept as they
    are, one row out per row in; other columns are ignored; an empty table gives an
    empty one. ``vocabulary`` is a file on the driver; tasks get its tables.
    """
    table = MergeTable(vocabulary)
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def start():
        counter = TokenCounter(table)

        def work(rows):
            n = counter([r["text"] for r in rows])
            return [
                (r["doc_id"], len(r["text"].encode("utf-8", "surrogatepass")), k, k > limit)
                for r, k in zip(rows, n, strict=True)
            ]

        return work

    kind = source.schema["doc_id"].dataType.simpleString()
    return map_rows(source, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", start)
