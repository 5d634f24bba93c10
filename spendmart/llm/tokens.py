"""Token ids of whole texts from a public tokenizer, with a bounded memory of encoded words.

Both vocabularies used here cut texts before a space or line break that stands between other
characters, so a text may be encoded word by word. Words not met lately are cut further, into runs of
letters, digits and marks, which both vocabularies merge apart. Where white space follows white space
the cut may lie elsewhere: unless white space makes no difference, such texts are encoded whole.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spendmart.llm.common import compactly_staged, lean

#: Words remembered; when half as many are new, those not met since the last time are forgotten.
MEMORY = 2_200_000
#: How byte-level vocabularies write bytes that aren't visible characters: as letters from U+0100 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
SPACE = chr(BYTES[32])
#: Letters that normal forms leave alone and that have one lower case each; marks but the apostrophe,
#: which may begin a contraction.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"


class Words(dict[str, "bytes | None"]):
    """Ids of the words met lately; asked for another, it learns it.

    None marks white space before white space: a text with it must be encoded whole.
    """

    def __init__(self, tool: Encoder, earlier: dict[str, bytes | None]):
        self.tool, self.earlier = tool, earlier

    def __missing__(self, word: str) -> bytes | None:
        ids = self.earlier.get(word)
        if ids is None:
            ids = self.tool.learned(word)
        self[word] = ids
        return ids


class Encoder:
    def __init__(self, name: str, memory: int = MEMORY):
        self.memory = memory
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text here
        self.merge = self.tokenizer.model.tokenize
        ids = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in ("Word", "word", " word", "\nword")]
        #: Whether case and white space make no difference to the ids.
        self.folds = all(x == ids[0] for x in ids)
        before, digits = ("", "[0-9]") if self.folds else (" ?", " ?[0-9]+")
        self.plain = re.compile(f"{before}[{_LETTERS}{_MARKS}0-9]+").fullmatch
        self.pieces = re.compile(f"{before}[{_LETTERS}]+|{digits}|{before}[{_MARKS}]+").findall
        self.known = Words(self, {})

    def learned(self, word: str) -> bytes | None:
        """The ids of a word. The pieces of a plain one go straight to the vocabulary's merges."""
        if self.plain(word):
            if word.isalpha() and (not self.folds or word.islower()):
                return self._merged(word)
            pieces = self.pieces(word.lower() if self.folds else word)
            if len(pieces) == 2:  # a word and its comma, as a rule
                return self.known[pieces[0]] + self.known[pieces[1]]  # type: ignore[operator]
            return b"".join([self.known[p] for p in pieces]) if pieces != [word] else self._merged(word)  # type: ignore[misc]
        if not self.folds and word and word[0] in " \n" and (len(word) == 1 or word[1].isspace()):
            return None
        return self._whole(word)

    def _merged(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(BYTES)
        elif piece[0] == " ":
            piece = SPACE + piece[1:]
        return array("I", [t.id for t in self.merge(piece)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str | None] | pa.Array) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text; a null text has none.

        Words are cut, told apart and put together again as Arrow arrays: each different one is looked
        up once.
        """
        if len(self.known) > self.memory // 2:
            self.known.earlier = {}
            self.known = Words(self, self.known)
        if not len(texts):
            return
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        texts = texts.cast(pa.large_string()).fill_null("")
        if self.folds:
            cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        else:
            marked = pc.replace_substring(pc.replace_substring(texts, "\n", "\0\n"), " ", "\0 ")
            cut = pc.split_pattern(marked, "\0")
        words = cut.flatten().dictionary_encode()
        ids = list(map(self.known.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)))
        bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        whole = np.zeros(len(texts), bool)
        if not self.folds:
            unfit = np.array([x is None for x in ids])[words.indices.to_numpy()]
            whole = np.diff(np.concatenate([[0], np.cumsum(unfit)])[bounds]) > 0
            whole |= pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False)
        joined = pa.array(ids, pa.large_binary()).take(words.indices)
        _, ends, data = joined.buffers()
        at = np.frombuffer(ends, np.int64)[joined.offset :][bounds].tolist()
        raw = memoryview(data if data is not None else b"")
        for i, (first, last) in enumerate(zip(at, at[1:])):
            yield self._whole(texts[i].as_py()) if whole[i] else bytes(raw[first:last])


@lru_cache(2)
def encoder(name: str, memory: int) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(name, memory)


#: A vocabulary of at most this many ids is stored in 16 bits an id.
SHORT = 1 << 16


def stored_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= SHORT else "<u4"


def tokenized(
    docs: DataFrame, key_cols: list[str], text_col: str, vocabulary: str, end_id: int, memory: int = MEMORY, words_last: bool = True
) -> tuple[DataFrame, str]:
    """Stage ``key_cols``, n_tokens, ids, part and inside for each row of ``docs``; and the ids' numpy type.

    ``end_id`` follows each text's ids. ``part`` is the writing task, ``inside`` the ids that it
    wrote before for rows with the same value in the last of ``key_cols``. ``memory`` bounds the
    words that a worker remembers, and without ``words_last`` it forgets them after each task; both
    change speed only.
    """
    size = Tokenizer.from_file(public_tokenizers.path(vocabulary)).get_vocab_size()
    kind = stored_type(max(size, end_id + 1))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = encoder(vocabulary, memory), TaskContext.get().partitionId()
        written: dict[object, int] = defaultdict(int)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for first in range(0, batch.num_rows, 500):
                some = texts.slice(first, 500)
                made = [np.frombuffer(ids + end, "<u4") for ids in tool.encode(some)]
                inside = []
                for key, ids in zip(batch.column(batch.num_columns - 2).slice(first, len(some)).to_pylist(), made):
                    inside.append(written[key])
                    written[key] += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(first, len(some)) for i in range(batch.num_columns - 1)),
                        pa.array([len(x) for x in made], pa.int64()),
                        pa.array([x.astype(kind).tobytes() for x in made], pa.binary()),
                        pa.array(np.full(len(some), part, np.int32)),
                        pa.array(inside, pa.int64()),
                    ],
                    names=[*batch.schema.names[:-1], "n_tokens", "ids", "part", "inside"],
                )
        if not words_last:
            del tool
            encoder.cache_clear()

    chosen = docs.select(*key_cols, F.col(text_col).cast("string").alias("text_to_encode"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    made = chosen.mapInArrow(lean(run), f"{schema}, n_tokens bigint, ids binary, part int, inside bigint")
    return compactly_staged(made, "token-ids"), kind
