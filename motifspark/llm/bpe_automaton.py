"""BPE encoding and decoding by a tokenization automaton.

The merge list is compiled into a deterministic automaton whose arcs carry tokens and whose accepted label
sequences are exactly the correct tokenizations. It starts as one state with a loop for every base symbol.
Each merge ``(a, b)`` in turn applies one *merge gadget*: all ``a`` arcs are led to a copy of their target that
has lost its ``b`` arc, and beside each such ``a`` arc a new ``ab`` arc goes to where ``b`` went before. All arcs
of one label share their target, so a state is named by the label that enters it; the copy is kept as the one arc
it lost plus a link to the state it was copied from (for ``ab`` that is the state of ``b`` at that moment), which
makes 49k gadgets a table of 49k entries instead of 49k x 49k arcs.

Words come from the tokenizer file's own splitting; each word is then spelled through the automaton from left to
right. For every prefix the automaton has exactly one path, so a word of n bytes costs O(n * longest token) table
look-ups at most, however long the word is. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from motifspark.llm.common import file_bytes

#: Words whose arcs are remembered in one Python worker; the table is emptied when it is full.
REMEMBERED = 400_000
#: Word ends carry this mark in the vocabulary.
END = "</w>"
#: How the splitting names white space (Unicode White_Space, which is narrower than Python's ``str.isspace``).
BLANK = "".join(map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


class TokenAutomaton:
    """States, arcs and labels compiled from a merge list."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        to_byte = {c: bytes([b]) for b, c in enumerate(byte_letters())}
        self.label = {i: s for s, i in vocab.items()}
        self.inner: dict[bytes, int] = {}  # spelling -> token inside a word
        self.final: dict[bytes, int] = {}  # spelling -> token that ends a word
        for s, i in vocab.items():
            ends = s.endswith(END) and len(s) > len(END)
            body = s[: -len(END)] if ends else s
            if all(c in to_byte for c in body):
                (self.final if ends else self.inner)[b"".join(to_byte[c] for c in body)] = i
        self.lost: dict[tuple[int, int], int] = {}  # (state, token) -> the gadget that took this arc away
        self.born: dict[int, tuple[int, int, int]] = {}  # token -> (its gadget, left part, right part)
        unreached: set[int] = set()  # tokens whose two parts never follow each other
        for step, (a, b) in enumerate(merges):
            if unreached.isdisjoint((vocab[a], vocab[b])) and self.alive(vocab[a], vocab[b]):
                self.gadget(step, vocab[a], vocab[b], vocab[a + b])
            else:
                unreached.add(vocab[a + b])
        self.inner = {s: i for s, i in self.inner.items() if i not in unreached}
        self.final = {s: i for s, i in self.final.items() if i not in unreached}
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.known: dict[tuple[int, int], bool] = {}

    def gadget(self, step: int, a: int, b: int, ab: int) -> None:
        if ab in self.born:
            raise ValueError(f"two merges make the token {self.label[ab]!r}")
        self.lost[a, b] = step  # state a is now the copy without b
        self.born[ab] = (step, a, b)  # state ab stays linked to what state b was before

    def gone(self, state: int, token: int, step: int) -> bool:
        """Has ``state`` lost its arc ``token`` by gadget ``step``, itself or before it was copied?"""
        while True:
            at = self.lost.get((state, token))
            if at is not None and at <= step:
                return True
            if state not in self.born:
                return False
            made, _, state = self.born[state]
            step = min(step, made - 1)

    def alive(self, state: int, token: int) -> bool:
        """Is there an arc ``token`` at ``state`` now? It was added only if its left part's arc was there in time."""
        part, step = token, 1 << 60
        while not self.gone(state, part, step):
            if part not in self.born:
                return True
            step, part, _ = self.born[part]
        return False

    def arc(self, state: int, token: int) -> bool:
        """The same for the finished automaton, remembered."""
        key = (state, token)
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= 4 * REMEMBERED:
                self.known.clear()
            found = self.known[key] = self.alive(state, token)
        return found

    def spell(self, word: bytes) -> list[int]:
        """Labels of the one path that spells ``word``: at each place the longest arc first, shorter ones when it leads nowhere.

        A place is reached by one path only, so a place from which no arc led on is never tried again.
        """
        n, longest, inner, final, arc = len(word), self.longest, self.inner, self.final, self.arc
        path: list[int] = []
        ends: list[int] = []  # where each arc of the path ends
        closed: set[int] = set()
        at, till, state = 0, min(n, longest), -1
        while at < n:
            while till > at:
                t = (inner if till < n else final).get(word[at:till])
                if t is not None and till not in closed and (state < 0 or arc(state, t)):
                    break
                till -= 1
            if till > at:
                path.append(t)
                ends.append(till)
                at, till, state = till, min(n, till + longest), t
            elif not path:
                raise ValueError("the vocabulary lacks a byte")
            else:  # one step back, then shorter
                closed.add(at)
                till = ends.pop() - 1
                path.pop()
                at, state = (ends[-1], path[-1]) if path else (0, -1)
        return path


def read_tokenizer(path: str) -> dict:
    """What is needed of a tokenizer file, as plain lists and dictionaries, which any Python worker can load."""
    spec = json.loads(file_bytes(path))
    model = spec["model"]
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    if steps != ["NFC", "Replace", "Lowercase"] or model["end_of_word_suffix"] != END or spec["decoder"] is not None:
        raise ValueError(f"{path}: not a tokenizer of this kind")
    return {"vocab": model["vocab"], "merges": [tuple(m) for m in model["merges"]], "special": {t["content"]: t["id"] for t in spec["added_tokens"]},
            "pattern": spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"[^\s", f"[^{BLANK}")}


class WordBpe:
    """What the tokenizer file asks for around the automaton: special strings, normalising, splitting into words."""

    def __init__(self, data: dict):
        self.automaton, self.special = TokenAutomaton(data["vocab"], data["merges"]), data["special"]
        marks = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.find, self.cut, self.marks = regex.compile(data["pattern"]).findall, regex.compile(marks).split, regex.compile(marks).findall
        self.seen: dict[str, tuple[bytes, str]] = {}
        self.label = self.automaton.label | {i: s for s, i in self.special.items()}

    @classmethod
    def of(cls, data: dict) -> WordBpe:
        """The model of a broadcast value, compiled once in each Python worker and kept beside it with its word table."""
        if "model" not in data:
            data["model"] = cls(data)
        return data["model"]

    def word(self, w: str) -> tuple[bytes, str]:
        ids = self.automaton.spell(w.encode())
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        if len(w) <= 64:
            found = self.seen[w] = (struct.pack(f"<{len(ids)}I", *ids), self.decode(ids))
            return found
        return struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)

    def pieces(self, text: str) -> list[tuple[bytes, str]]:
        """(ids as little-endian bytes, decoded text) of each word and special string, in order."""
        seen, word = self.seen, self.word
        out: list[tuple[bytes, str]] = []
        marks = [*self.marks(text), None] if "<|" in text else [None]
        for part, mark in zip(self.cut(text) if len(marks) > 1 else [text], marks, strict=True):
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # each letter by itself: no final sigma
            out += [seen.get(w) or word(w) for w in self.find(part.lower())]
            if mark is not None:
                out.append((struct.pack("<I", self.special[mark]), mark))
        return out

    def encode(self, text: str | None) -> bytes:
        return b"".join([p[0] for p in self.pieces(text or "")])

    def decode(self, ids: list[int]) -> str:
        """The labels of the path, joined by one space: the file names no decoder."""
        return " ".join([self.label[i] for i in ids])


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep: tuple[str, ...] = ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")) -> DataFrame:
    """One row per document with the columns of ``keep``: its token ids, the text they decode to, and their digests.

    One narrow Arrow pass: no shuffle, whole texts, memory of one Arrow batch and a bounded word table. A null text
    counts as empty: no ids, empty decoded text. Strings of special tokens in a text become those tokens, as in the
    file's own library. Repeated rows and ids, and null ids, each give their own row; other columns are not read.
    """
    kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.string(), "ids_sha256": pa.string(),
             "decoded_sha256": pa.string()}
    names = {"n_tokens": "bigint", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
    shared = docs.sparkSession.sparkContext.broadcast(read_tokenizer(path))  # bounded by the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = WordBpe.of(shared.value)
        for batch in batches:
            got: dict[str, list] = {k: [] for k in keep}
            for text in batch.column(1).to_pylist():
                found = m.pieces(text or "")
                ids = b"".join([p[0] for p in found])
                if "n_tokens" in got:
                    got["n_tokens"].append(len(ids) // 4)
                if "ids" in got:
                    got["ids"].append(struct.unpack(f"<{len(ids) // 4}I", ids))
                if "ids_sha256" in got:
                    got["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                if "decoded" in got or "decoded_sha256" in got:
                    text = " ".join([p[1] for p in found])
                    if "decoded" in got:
                        got["decoded"].append(text)
                    if "decoded_sha256" in got:
                        got["decoded_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, kinds[k]) for k, v in got.items())], [id_col, *keep])

    head = docs.select(id_col, text_col)
    return head.mapInArrow(run, f"`{id_col}` {head.schema[0].dataType.simpleString()}, " + ", ".join(f"{k} {names[k]}" for k in keep))


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded): the text that a column of token ids spells; null ids decode to the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_tokenizer(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = WordBpe.of(shared.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], [id_col, "decoded"])

    head = encoded.select(id_col, ids_col)
    return head.mapInArrow(run, f"`{id_col}` {head.schema[0].dataType.simpleString()}, decoded string")
