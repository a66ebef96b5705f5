"""BPE encoding and decoding through a tokenization automaton.

The merges define, in order, a deterministic automaton over tokens. It starts
as one state with a loop for each base symbol. All arcs of a label lead to the
same state, and every merge ``a b -> c`` adds one gadget: the state that the
``a`` arcs lead to is copied without its ``b`` arc, the ``a`` arcs are sent to
the copy, and next to every ``a`` arc a ``c`` arc goes to where ``b`` leads. The
automaton accepts exactly the token sequences that merging produces, one for
each word, so encoding a word is to find its only accepting path.

It is compiled merge by merge when a vocabulary is loaded, into two tables: the
state that each label leads to, and for each state a row that says of each label
whether the state has its arc. Rows are kept by the places at which that changes.
Rows of states that no arc leads to any more are used again, so the table has a
row for each state that is left in the end.

A gadget's ``c`` arcs go by the ``a`` arcs of every state, also of states that
are copied later. Labels are therefore numbered so that those which start with
the same label, at any number of merges back, follow it in the order of their
making: a state that loses its ``b`` arc when ``c`` is made loses with it the
arcs that would be made from ``b`` from then on, and these are the end of the
numbers that follow ``b``. One copied row with one stretch of arcs taken out is
then all that a gadget takes.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.common import ship

#: The pre-split pattern, special tokens' strings aside, of the vocabulary file's format.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
#: Characters whose class depends on the version of Unicode; texts with any are split by the format's own splitter.
RARE = r"[^\x00-\u0377\u2000-\u2027\u202f-\u205e\u20ac]"
#: Entries of the word table in a Python worker; a full table starts anew.
TABLE_ENTRIES = 200_000
#: Ids that a task holds for the rows it hands on at a time.
PART_IDS = 300_000
#: Longer words are encoded each time they occur.
WORD_CHARS = 40


def byte_symbols() -> dict[str, int]:
    """Printable stand-in of each byte: itself where printable, else the next free code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _clear(row: array, first: int, end: int) -> None:
    """Take the labels from ``first`` up to ``end`` out of a row; every second place of a row is where labels are there again."""
    if first >= end:
        return
    i, j = bisect_left(row, first), bisect_right(row, end)
    row[i:j] = array("I", ([] if i & 1 else [first]) + ([] if j & 1 else [end]))


class TokenAutomaton:
    """Deterministic automaton of a byte-level BPE vocabulary with word ends.

    Symbols are characters: byte ``b`` is ``chr(b)``, and ``chr(256 + b)`` where
    it ends a word.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.labels: dict[int, str] = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.labels |= {i: t for t, i in self.special.items()}
        back = byte_symbols()

        def symbols(token: str) -> str:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            body = [chr(back[c]) for c in (token[: -len(self.suffix)] if ends else token)]
            if ends:
                body[-1] = chr(ord(body[-1]) + 256)
            return "".join(body)

        ids = model["vocab"]
        reachable = {}
        for token, i in ids.items():
            text = symbols(token)
            if len(text) == 1:
                reachable[i] = text
        merges: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, c = ids[left], ids[right], ids[left + right]
            if a in reachable and b in reachable and (a, b) not in merges:
                if c in reachable:
                    raise ValueError(f"more than one merge makes {left + right!r}")
                merges[a, b] = c
                reachable[c] = reachable[a] + reachable[b]
        while (never := self._compile([(a, b, c) for (a, b), c in merges.items()], list(reachable))) is not None:
            # Earlier merges leave no such neighbours: this merge is never applied, and what it makes is never there.
            gone = {merges.pop(never)}
            for (a, b), c in list(merges.items()):
                if a in gone or b in gone:
                    gone.add(merges.pop((a, b)))
            reachable = {i: text for i, text in reachable.items() if i not in gone}
        self.trie: dict = {}
        for i, text in reachable.items():
            node = self.trie
            for c in text:
                node = node.setdefault(c, {})
            node[""] = i
        self.words: dict[str, tuple[int, ...]] = {}
        self._split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._split = regex.compile(PRE_SPLIT)
        self._rare = regex.compile(RARE)
        # The format's own splitter, for rare characters, needs no vocabulary.
        self._split_spec = {"model": {"type": "BPE", "vocab": {}, "merges": []}} | {k: spec.get(k) for k in ("normalizer", "pre_tokenizer")}
        self._splitter = None
        self._from_byte = {ord(c): chr(b) for c, b in back.items()}

    def _compile(self, merges: list[tuple[int, int, int]], labels: list[int]) -> tuple[int, int] | None:
        """The tables of the automaton, one gadget after the other; or the first merge that is never applied.

        ``place`` numbers the labels, ``target`` has the row of the state that a
        label leads to, and row ``target`` of ``table`` has the places from which
        on that state lacks arcs and, by turns, has them again.
        """
        made = {c: rank for rank, (_, _, c) in enumerate(merges)}
        starting: dict[int, list[int]] = {}  # label to those made from it as their first part, in order
        for a, _, c in merges:
            starting.setdefault(a, []).append(c)
        place: dict[int, int] = {}
        end: dict[int, int] = {}
        todo = [(i, False) for i in labels if i not in made]
        while todo:
            i, done = todo.pop()
            if done:
                end[i] = len(place)
                continue
            place[i] = len(place)
            todo.append((i, True))
            todo += [(c, False) for c in reversed(starting.get(i, ()))]
        table = [array("I")]
        target = {i: 0 for i in labels if i not in made}
        arrivals = [len(target)]
        for rank, (a, b, c) in enumerate(merges):
            state, first = target[a], place[b]
            if bisect_right(table[state], first) & 1:
                return a, b
            target[c] = target[b]
            arrivals[target[b]] += 1
            copy = state
            if arrivals[state] > 1:  # else nothing but the arcs that move to the copy leads to the state, which becomes the copy
                copy = target[a] = len(table)
                table.append(table[state][:])
                arrivals[state] -= 1
                arrivals.append(1)
            row = table[copy]
            _clear(row, first, first + 1)
            # What b starts from this merge on; a label made by an earlier merge has its arcs already.
            later = next((place[x] for x in starting.get(b, ()) if made[x] >= rank), end[b])
            _clear(row, later, end[b])
        self.place, self.target, self.table, self.n_states = place, target, table, len(table)
        return None

    def arc(self, last: int, token: int) -> bool:
        """Whether the state after ``last`` has an arc labelled ``token``."""
        return not bisect_right(self.table[self.target[last]], self.place[token]) & 1

    def encode_symbols(self, s: str) -> tuple[int, ...]:
        """The accepting path over ``s``, longest arcs tried first.

        Every partial path is the only one over its prefix, so a position that
        led nowhere never has to be tried again: time is linear in the word.
        """
        n, trie, arc = len(s), self.trie, self.arc
        path: list[int] = []
        ends: list[int] = [0]
        todo: list[list[tuple[int, int]]] = []
        dead: set[int] = set()
        at = 0
        while at < n:
            if len(todo) == len(path):
                node, found, j = trie, [], at
                while j < n:
                    node = node.get(s[j])
                    if node is None:
                        break
                    j += 1
                    t = node.get("")
                    if t is not None and j not in dead:
                        found.append((t, j))
                todo.append(found)
            options = todo[-1]
            while options:
                t, j = options.pop()
                if j not in dead and (not path or arc(path[-1], t)):
                    path.append(t)
                    ends.append(j)
                    at = j
                    break
            else:
                todo.pop()
                if not path:
                    return ()
                dead.add(at)
                path.pop()
                ends.pop()
                at = ends[-1]
        return tuple(path)

    def encode_word(self, word: str) -> tuple[int, ...]:
        known = self.words.get(word)
        if known is None:
            s = word.encode("utf-8", "surrogatepass").decode("latin-1")
            if self.suffix:
                s = s[:-1] + chr(ord(s[-1]) + 256)
            known = self.encode_symbols(s)
            if len(word) <= WORD_CHARS:
                if len(self.words) >= TABLE_ENTRIES:
                    self.words.clear()
                self.words[word] = known
        return known

    def _rare_words(self, text: str) -> Iterator[tuple[int, ...]]:
        if self._splitter is None:
            from tokenizers import Tokenizer

            self._splitter = Tokenizer.from_str(json.dumps(self._split_spec))
        for w, _ in self._splitter.pre_tokenizer.pre_tokenize_str(self._splitter.normalizer.normalize_str(text)):
            s = w.translate(self._from_byte)
            yield self.encode_symbols(s[:-1] + chr(ord(s[-1]) + 256) if self.suffix else s)

    @staticmethod
    def normalize(text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        # Lower case goes by single characters: a final sigma has no rule of its own.
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        pieces = self._split_special.split(text or "") if self._split_special else [text or ""]
        for k, piece in enumerate(pieces):
            if k % 2:
                ids.append(self.special[piece])
                continue
            if self._rare.search(piece):
                for t in self._rare_words(piece):
                    ids += t
                continue
            found = self._split.findall(self.normalize(piece))
            known = list(map(self.words.get, found))
            if None in known:
                known = [self.encode_word(w) if t is None else t for w, t in zip(found, known, strict=True)]
            ids += chain.from_iterable(known)
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        """The arc labels, special tokens too, joined by a space: the format sets no decoder."""
        labels = self.labels
        return " ".join([labels[i] for i in ids if i in labels])


#: What a vocabulary file has to say of itself.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def unsupported(spec: dict) -> list[str]:
    """What a vocabulary file asks for that this module does not do."""
    model = spec.get("model", {})
    found = [name for name, want in (("normalizer", NORMALIZER), ("pre_tokenizer", PRE_TOKENIZER), ("decoder", None), ("post_processor", None)) if spec.get(name) != want]
    found += [f"model.{k}" for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    if model.get("type", "BPE") != "BPE":
        found.append("model.type")
    return found + [f"added token {t['content']}" for t in spec.get("added_tokens", []) if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]


_LOADED: dict[str, TokenAutomaton] = {}


def automaton(path: str) -> TokenAutomaton:
    """The automaton of a vocabulary file, compiled once in each Python worker; raises if the file asks for what is not supported."""
    if path not in _LOADED:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if other := unsupported(spec):
            raise ValueError(f"{path}: not supported: {', '.join(other)}")
        _LOADED[path] = TokenAutomaton(spec)
    return _LOADED[path]


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def _in_parts(encoded: Iterable[list[int]]) -> Iterator[tuple[int, list[list[int]]]]:
    """(first row, ids of the rows) of runs of rows that together hold a bounded number of ids, or are one row."""
    start, part, held = 0, [], 0
    for ids in encoded:
        if part and held + len(ids) > PART_IDS:
            yield start, part
            start, part, held = start + len(part), [], 0
        part.append(ids)
        held += len(ids)
    if part:
        yield start, part


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", out_col: str = "token_ids", decoded_col: str | None = None) -> DataFrame:
    """Add ``out_col``, the token ids (array<int>) of each whole text, and ``decoded_col``, if given, the text that they decode to.

    A null or empty text, or one of white space only, has no tokens (an empty
    array). Every row stays, repeated ones too; other columns pass through. A
    column that is already called ``out_col`` or ``decoded_col`` is replaced.
    An empty table gives an empty one. ``vocabulary`` is a path that executors
    can read. To decode here, and not in ``decode``, spares a second Python
    worker beside each task's.
    """
    ship(docs.sparkSession)
    docs = docs.drop(out_col) if decoded_col is None else docs.drop(out_col, decoded_col)
    at = docs.columns.index(text_col)
    added = [T.StructField(out_col, T.ArrayType(T.IntegerType(), False))] + ([T.StructField(decoded_col, T.StringType())] if decoded_col else [])
    schema = T.StructType([*docs.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(vocabulary)
        for batch in batches:
            for start, part in _in_parts(a.encode(t.as_py()) for t in batch.column(at)):
                offsets = np.concatenate([[0], np.cumsum([len(ids) for ids in part])]).astype(np.int32)
                flat = np.concatenate([np.array(ids, np.int32) for ids in part]).astype(np.int32)
                out = _with_column(batch.slice(start, len(part)), out_col, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                yield out if decoded_col is None else _with_column(out, decoded_col, pa.array([a.decode(ids) for ids in part], pa.string()))

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, vocabulary: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """Add ``out_col``, the text of the ids: their labels joined by a space.

    Null or empty ids give an empty text; ids that the vocabulary lacks are
    left out, as are null ones.
    """
    ship(tokens.sparkSession)
    tokens = tokens.drop(out_col)
    at = tokens.columns.index(ids_col)
    schema = T.StructType([*tokens.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(vocabulary)
        for batch in batches:
            yield _with_column(batch, out_col, pa.array([a.decode(ids.as_py() or ()) for ids in batch.column(at)], pa.string()))

    return tokens.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: number of tokens and SHA-256 of its ids and of the text that they decode to.

    Ids pass from ``TokenAutomaton.encode`` to ``decode`` inside the task, so that only digests leave it.
    Null text counts as empty and has no tokens; texts are encoded whole, however
    long. Every row has its answer, repeated ones the same, and a null doc_id
    stays null. Other columns, whatever their names, are not read. An empty
    table gives an empty one.
    """
    ship(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_text", T.StringType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(vocabulary)
        numerals = {i: str(i) for i in a.labels}
        for batch in batches:
            for start, part in _in_parts(a.encode(t.as_py()) for t in batch.column(1)):
                columns = [
                    batch.column(0).slice(start, len(part)),
                    pa.array([len(ids) for ids in part], pa.int64()),
                    pa.array([" ".join([numerals[i] for i in ids]) for ids in part], pa.string()),
                    pa.array([a.decode(ids) for ids in part], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_text", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(run, schema).select("doc_id", "n_tokens", F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
