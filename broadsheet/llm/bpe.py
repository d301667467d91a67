"""Byte-pair encoding with an automaton over tokens.

The merges are compiled one after the other. At first one state has an arc to itself for every
base symbol. The gadget of a merge (u, v) -> w splits the state that all u arcs enter: u arcs
now enter a copy without the v arc, and every state with a u arc gets a w arc to where v led.
So a path reads u and then v only where the merge could not have applied, and each symbol
sequence has exactly one path: its encoding. All arcs of one token enter the same state, hence
the compiled form is small: per token the state it enters and the merge it comes from, per
state the row of copies it stands in and the arc that was taken away. Whether a state has an
arc is looked up along those rows once and then kept in a table.

Words are encoded by running all arcs from left to right; decoding emits the labels of the
arcs. Words seen before in the same task are taken from a table of bounded size.

Defined results: null and empty texts give no tokens and an empty decoded text. The strings of
the two special tokens are recognised in raw text, as the vocabulary file asks.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words and arcs that a task keeps; beyond, the table starts anew (results don't change).
KEPT_WORDS = 300_000
KEPT_ARCS = 1_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Automaton:
    """States and arcs that the merges leave; see the module's text."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.ids, self.end = vocabulary, end
        self.enters = dict.fromkeys(vocabulary.values(), 0)
        self.left: dict[int, int] = {}
        self.born = dict.fromkeys(vocabulary.values(), -1)
        #: Per state the merge that made it and the row of copies it belongs to; a row holds
        #: the successive copies for one token: their merges, states, lost arcs and origin.
        self.made, self.row = [-1], [None]
        rows: dict[int, tuple[list[int], list[int], dict[int, int], int]] = {}
        for turn, (first, second) in enumerate(merges):
            u, v, w = vocabulary[first], vocabulary[second], vocabulary[first + second]
            to = self.enters[v]
            turns, states, lost, _ = rows.setdefault(u, ([], [], {}, self.enters[u]))
            state = len(self.made)
            turns.append(turn)
            states.append(state)
            lost[v] = turn
            self.made.append(turn)
            self.row.append(rows[u])
            self.enters[u], self.enters[w] = state, to
            self.left[w], self.born[w] = u, turn
        stems = (n.removesuffix(end) if end else n for n in vocabulary)
        self.begun = {n[:k] for n in stems for k in range(1, len(n) + 1)}
        self.arcs: dict[tuple[int, int], bool] = {}

    def has_arc(self, state: int, token: int) -> bool:
        """Follow the gadgets back until a base symbol in the first state, or a lost arc."""
        known = self.arcs.get((state, token))
        if known is not None:
            return known
        s, t = state, token
        while True:
            if s == 0:
                found = True
                break
            turns, states, lost, origin = self.row[s]
            if lost.get(t, self.made[s] + 1) <= self.made[s]:
                found = False
                break
            born = self.born[t]
            if born >= self.made[s]:
                t = self.left[t]
                continue
            older = bisect_right(turns, born) - 1
            s = states[older] if older >= 0 else origin
        if len(self.arcs) >= KEPT_ARCS:
            self.arcs.clear()
        self.arcs[(state, token)] = found
        return found

    def encode(self, word: str) -> list[int]:
        """Token ids of one word, given in byte symbols."""
        size, end = len(word), self.end
        states: list[int] = [0] + [-1] * size
        back: list[int] = [0] * (size + 1)
        ids, begun, has_arc = self.ids, self.begun, self.has_arc
        for at in range(size):
            state = states[at]
            if state < 0:
                continue
            for stop in range(at + 1, size + 1):
                piece = word[at:stop]
                if piece not in begun:
                    break
                if states[stop] >= 0:
                    continue
                token = ids.get(piece if stop < size else piece + end)
                if token is not None and has_arc(state, token):
                    states[stop] = self.enters[token]
                    back[stop] = token << 32 | at
        out, at = [], size
        while at:
            out.append(back[at] >> 32)
            at = back[at] & 0xFFFFFFFF
        out.reverse()
        return out


class Encoder:
    """Splits texts as the vocabulary file says, encodes each word once, and decodes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {k: v for k, v in model["vocab"].items() if k not in self.special}
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(vocabulary, merges, model["end_of_word_suffix"] or "")
        self.labels = {i: s for s, i in {**vocabulary, **self.special}.items()}
        words = next(
            p["pattern"]["Regex"]
            for p in spec["pre_tokenizer"]["pretokenizers"]
            if p["type"] == "Split"
        )
        self.word = regex.compile(words)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.symbols = byte_symbols()
        self.known: dict[str, tuple[bytes, str]] = {}

    def of_word(self, word: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the labels that decoding emits."""
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        symbols = self.symbols
        ids = self.automaton.encode("".join([symbols[b] for b in word.encode()]))
        out = struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
        if len(word) <= 64:
            self.known[word] = out
        return out

    def decode(self, ids: list[int]) -> str:
        """Arc labels with a space between, as a vocabulary without a decoder is read."""
        labels = self.labels
        return " ".join([labels[i] for i in ids])

    def of_text(self, text: str) -> tuple[bytes, str]:
        found = []
        known, of_word = self.known, self.of_word
        parts = self.cut.split(text) if "<|" in text else [text]
        for part in parts:
            if part in self.special:
                token = self.special[part]
                found.append((struct.pack("<I", token), self.labels[token]))
                continue
            # Characters are lowered one by one: no final form of sigma.
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            for word in self.word.findall(part):
                found.append(known.get(word) or of_word(word))
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def encoded(docs: DataFrame, path: str, ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``ids`` the ids themselves.

    ``path`` names the vocabulary file on every executor. No row leaves its task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Looked up here, so that the worker keeps the compiled automaton between tasks.
        from broadsheet.llm import bpe

        one = bpe.encoder(path)
        for batch in batches:
            keys, texts = batch.column("doc_id"), batch.column("text")
            for lo in range(0, len(keys), 500):
                part = [one.of_text(t.as_py() or "") for t in texts.slice(lo, 500)]
                columns = [
                    keys.slice(lo, 500),
                    pa.array([len(a) // 4 for a, _ in part], pa.int64()),
                    pa.array([hashlib.sha256(a).hexdigest() for a, _ in part]),
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for _, b in part]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    lists = [list(struct.unpack(f"<{len(a) // 4}I", a)) for a, _ in part]
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, schema + (", ids array<int>" if ids else ""))
