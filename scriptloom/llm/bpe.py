"""BPE encoding and decoding with a public word-end vocabulary (tokenizers JSON file).

Encoding is the backtracking form of BPE. Aho-Corasick finds the longest token that starts at a
position; it is kept if it is compatible with the token before it, that is, if merging the two
tokens' text by the merge rules gives back exactly these two tokens. Otherwise the next shorter
token is tried, and if none is left the token before is taken back. A sequence whose neighbours
are all compatible is the result of the merge rules, so the ids are exact; a dead end is marked and
never entered again, so the work is linear in the length of the word.

Decoding looks each id up in a table of offsets into one byte string of all tokens.

Defined results: null text is the empty text; empty text has no ids and decodes to the empty text;
repeated rows give repeated rows; input columns other than the two named ones are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Texts of these characters only: lower-casing, composition and word classes are the same in every
# Unicode version, and white space bounds all words. Other texts take the general way.
PLAIN = re.compile("[\t-\r -\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ‐-‧]*")
CACHED = 800_000  # chunks of text whose ids a worker keeps


class Vocabulary:
    """The tables of one vocabulary file, built once in each worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        split = next(
            s for s in spec["pre_tokenizer"]["pretokenizers"] if s["type"] == "Split"
        )
        self.words = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile(
            "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)"
        )
        self.of_byte = byte_letters()
        # Letters of a token: one letter for each byte; the last byte of a word has a letter of
        # its own, so that the word end needs no extra sign.
        back = {letter: chr(byte) for byte, letter in enumerate(self.of_byte)}

        def letters(token: str) -> str:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            plain = token[: -len(self.suffix)] if ends else token
            spelled = "".join(back[x] for x in plain)
            return spelled[:-1] + chr(256 + ord(spelled[-1])) if ends else spelled

        self.id_of = {letters(t): i for t, i in model["vocab"].items()}
        self.letters = {i: t for t, i in self.id_of.items()}
        ids = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.after: dict[int, dict[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (ids[left], ids[right]), ids[left + right]
            self.rank[pair] = rank
            self.after.setdefault(pair[0], {})[pair[1]] = rank
            self.parts.setdefault(whole, (rank, *pair))
        self.id_of = {t: i for t, i in self.id_of.items() if self._reachable(i)}
        self.matcher = ahocorasick.Automaton()
        for token, i in self.id_of.items():
            self.matcher.add_word(token, (len(token), i))
        self.matcher.make_automaton()
        self.compatible_pairs: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        self.spines: dict[tuple[int, bool], list[tuple[int, float]]] = {}
        self.chunks: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}

        size = 1 + max([*self.letters, *self.special.values()])
        texts = [b""] * size
        for token, i in ids.items():
            texts[i] = token.encode()
        for token, i in self.special.items():
            texts[i] = token.encode()
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths)))
        self.bytes = np.frombuffer(b"".join(texts) + b" ", dtype=np.uint8)

    # --- merge rules ------------------------------------------------------------------------

    def _reachable(self, token: int) -> bool:
        """Whether the merge rules ever give this token: its last merge joins compatible parts."""
        if len(self.letters[token]) == 1:
            return True
        if token not in self.parts:
            return False
        own, left, right = self.parts[token]
        return not any(
            rank < own and rank < end_x and rank <= end_y
            for x, end_x in self._spine(left, False)
            for y, end_y in self._spine(right, True)
            if (rank := self.rank.get((x, y))) is not None
        )

    def _spine(self, token: int, left: bool) -> list[tuple[int, float]]:
        """The parts at one edge of a token, each with the rank of the merge that ends it."""
        edge, end = [], float("inf")
        while True:
            edge.append((token, end))
            if token not in self.parts:
                return edge
            end, first, last = self.parts[token]
            token = first if left else last

    def compatible(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of ``a`` and ``b`` before its sides are merged away.

        Of two merges of one rank the left one comes first.
        """
        known = self.compatible_pairs.get((a, b))
        if known is None:
            known = self._fits(a, b)
            if len(self.compatible_pairs) >= 1_000_000:
                self.compatible_pairs.clear()
            self.compatible_pairs[a, b] = known
        return known

    def _fits(self, a: int, b: int) -> bool:
        for key in ((a, False), (b, True)):
            if key not in self.spines:
                self.spines[key] = self._spine(*key)
        begins = self.spines[b, True]
        for x, end_x in self.spines[a, False]:
            merges = self.after.get(x)
            if merges:
                for y, end_y in begins:
                    rank = merges.get(y)
                    if rank is not None and rank < end_x and rank <= end_y:
                        return False
        return True

    def next_shorter(self, token: int) -> int:
        """The longest other token that this one begins with, or -1."""
        known = self.shorter.get(token)
        if known is None:
            text, known = self.letters[token], -1
            for end in range(len(text) - 1, 0, -1):
                found = self.id_of.get(text[:end])
                if found is not None:
                    known = found
                    break
            self.shorter[token] = known
        return known

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word (as the word pattern cuts it)."""
        spelled = word.encode().decode("latin-1")
        if self.suffix:
            spelled = spelled[:-1] + chr(256 + ord(spelled[-1]))
        whole = self.id_of.get(spelled)
        if whole is not None:
            return [whole]
        longest: list[int] = [-1] * len(spelled)
        size = [0] * len(spelled)
        for end, (length, token) in self.matcher.iter(spelled):
            start = end - length + 1
            if length > size[start]:
                size[start], longest[start] = length, token
        open_at = bytearray(b"\x01") * (len(spelled) + 1)  # positions that are no dead end
        ids: list[int] = []
        letters, pairs = self.letters, self.compatible_pairs
        at, token = 0, longest[0]
        while at < len(spelled):
            last = ids[-1] if ids else -1
            while token >= 0:
                end = at + len(letters[token])
                if open_at[end]:
                    fits = last < 0 or pairs.get((last, token))
                    if fits or fits is None and self.compatible(last, token):
                        break
                token = self.next_shorter(token)
            if token >= 0:
                ids.append(token)
                at = end
                token = longest[at] if at < len(spelled) else -1
            else:
                if last < 0:
                    raise ValueError("the vocabulary has no token for a byte of the text")
                open_at[at] = 0
                ids.pop()
                at -= len(self.letters[last])
                token = self.next_shorter(last)
        return ids

    # --- texts ------------------------------------------------------------------------------

    def _words(self, words: list[str]) -> bytes:
        known = self.word_ids
        for word in words:
            if word not in known:
                if len(known) >= CACHED:
                    known.clear()
                    return b"".join(
                        np.array(self.encode_word(w), dtype="<u4").tobytes() for w in words
                    )
                known[word] = np.array(self.encode_word(word), dtype="<u4").tobytes()
        return b"".join([known[word] for word in words])

    def _plain(self, text: str) -> bytes:
        pieces = text.lower().split()
        known = self.chunks
        found = list(map(known.get, pieces))
        if None in found:
            for at, ids in enumerate(found):
                if ids is None:
                    piece = pieces[at]
                    ids = known.get(piece)
                    if ids is None:
                        if len(known) >= CACHED:
                            known.clear()
                        ids = self._words(self.words.findall(piece))
                        if len(piece) <= 64:
                            known[piece] = ids
                    found[at] = ids
        return b"".join(found)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        if not text:
            return b""
        out, start = [], 0
        marks = self.specials.finditer(text) if "<" in text else ()
        for mark in [*marks, None]:
            part = text[start : mark.start() if mark else len(text)]
            if PLAIN.fullmatch(part):
                out.append(self._plain(part))
            else:
                # each letter alone: no rule looks at the letters around a capital sigma
                low = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                out.append(self._words(self.words.findall(low)))
            if mark:
                out.append(self.special[mark[0]].to_bytes(4, "little"))
                start = mark.end()
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' texts with a blank between them, as UTF-8."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        starts = np.cumsum(lengths + 1) - lengths - 1
        out = np.full(int(starts[-1] + lengths[-1]), 32, dtype=np.uint8)
        total = int(lengths.sum())
        before = np.cumsum(lengths) - lengths
        inside = np.arange(total) - np.repeat(before, lengths)
        out[np.repeat(starts, lengths) + inside] = self.bytes[
            np.repeat(self.offsets[ids], lengths) + inside
        ]
        return out.tobytes()


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for byte in range(256):
        if byte in shown:
            letters.append(chr(byte))
        else:
            letters.append(chr(extra))
            extra += 1
    return letters


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode_decode(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per input row: id, n_tokens, digests of ids and decoded text, and the ids if asked.

    A projection: no row meets another. Memory is one batch of rows and the bounded tables.
    """
    schema = f"{id_column} long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(path)
        for batch in batches:
            texts = batch.column(1)
            for start in range(0, len(texts), 256):
                part = batch.slice(start, 256)
                counts, of_ids, of_text, kept = [], [], [], []
                for text in part.column(1):
                    coded = table.encode(text.as_py())
                    ids = np.frombuffer(coded, dtype="<u4")
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(coded).hexdigest())
                    decoded = hashlib.sha256()
                    for at in range(0, len(ids), 65536):
                        decoded.update(b" " * (at > 0) + table.decode(ids[at : at + 65536]))
                    of_text.append(decoded.hexdigest())
                    if with_ids:
                        kept.append(ids.astype(np.int32))
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema_names(schema))

    chosen = docs.select(
        docs[id_column].cast("long").alias(id_column), docs[text_column].alias("text")
    )
    return chosen.mapInArrow(run, schema)


def schema_names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]
