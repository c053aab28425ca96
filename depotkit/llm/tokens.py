"""Token ids of a public byte-level BPE: each distinct unit between blanks is encoded once a block."""

from __future__ import annotations

import base64
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_CHARS = 12_000_000
#: Units that are encoded together: Latin letters and signs, no white space or control characters.
PLAIN_UNIT = r"^ ?[\x21-\x7E\x{A1}-\x{24F}]{1,200}$"


class Encoder:
    """``encode(texts)`` gives each text's ids as an array of unsigned 32-bit numbers.

    The vocabulary splits a text before each blank, and around each line end, that stands between
    two other characters; no token crosses such a place. A block of texts is cut there into units,
    and each distinct unit is encoded once: plain ones in one call by the same vocabulary given as
    ranks, cut apart by their byte lengths, others by the tokenizer itself. A text with other white
    space at such a place goes whole to the tokenizer.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        import public_tokenizers
        import tiktoken

        self.name = name
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.token_bytes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.token_bytes[rank] = len(token)

    @cached_property
    def whole(self):
        """The tokenizer itself, loaded by the first text that needs it."""
        import public_tokenizers
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(public_tokenizers.path(f"{self.name}.json"))
        found.encode_special_tokens = True
        return found

    def _slow(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _joined(self, units: pa.Array, glue: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the units in one array, and each unit's first and last place in it."""
        ids = np.array(self.ranks.encode_ordinary(glue.join(units.to_pylist())), dtype="<u4")
        lengths = pc.binary_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(self.token_bytes[ids])
        stops = np.cumsum(lengths + len(glue)) - len(glue)
        return ids, np.searchsorted(ends, stops - lengths, "right"), np.searchsorted(ends, stops, "right")

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids in one array; each unit's start and count; whether it can't stand alone."""
        n = len(units)
        start, count, bad = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        plain = pc.match_substring_regex(units, PLAIN_UNIT).to_numpy(zero_copy_only=False)
        blank = pc.starts_with(units, " ").to_numpy(zero_copy_only=False)
        line_end = pc.equal(units, "\n").to_numpy(zero_copy_only=False)  # alone it is one token
        parts, size = [], 0
        for chosen, glue in ((plain & blank, ""), (plain & ~blank, "\n"), (line_end, "")):
            where = np.flatnonzero(chosen)
            if len(where):
                ids, first, last = self._joined(units.take(pa.array(where)), glue)
                start[where], count[where] = first + size, last - first
                parts.append(ids)
                size += len(ids)
        for k in np.flatnonzero(~plain & ~line_end).tolist():
            unit = units[k].as_py()
            core = unit[1:] if unit[:1] == " " else unit
            if not core or core[0].isspace() or core[-1].isspace():
                bad[k] = True
                continue
            ids = self._slow(unit)
            start[k], count[k] = size, len(ids)
            parts.append(ids)
            size += len(ids)
        return np.concatenate(parts) if parts else np.zeros(0, "<u4"), start, count, bad

    def _block(self, texts: list[str]) -> list[np.ndarray]:
        column = pa.array(texts, pa.large_string())
        marked = pc.replace_substring(pc.replace_substring(column, " ", "\0 "), "\n", "\0\n\0")
        lists = pc.split_pattern(marked, "\0")
        units = pc.dictionary_encode(lists.flatten())
        which = units.indices.to_numpy()
        ids, start, count, bad = self._units(units.dictionary)
        begins = lists.offsets.to_numpy().astype(np.int64)
        begins, ends = begins[:-1] - begins[0], begins[1:] - begins[0]
        slow = pc.match_substring(column, "\0").to_numpy(zero_copy_only=False) | (np.add.reduceat(bad[which], begins) > 0)
        counts = count[which]
        total = np.concatenate(([0], np.cumsum(counts)))
        flat = ids[np.repeat(start[which] - total[:-1], counts) + np.arange(total[-1])]
        empty = np.zeros(0, "<u4")
        return [
            empty if not text else self._slow(text) if late else flat[total[a]:total[b]]
            for text, late, a, b in zip(texts, slow.tolist(), begins.tolist(), ends.tolist(), strict=True)
        ]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        out, block, size = [], [], 0
        for text in texts:
            block.append(text or "")
            size += len(block[-1])
            if size >= BLOCK_CHARS:
                out += self._block(block)
                block, size = [], 0
        return out + self._block(block) if block else out


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str = "byte_bpe_50k") -> Encoder:
    """This worker's encoder."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]
