"""Words, word ids and shingles of whole texts, in Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: ASCII signs without the apostrophe, which tokenizers treat apart.
SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'").encode()
LETTERS_SIGNS = re.compile(b"([A-Za-z]+)([" + re.escape(SIGNS) + b"]*)")
#: Stands for the end of a document among its words; no word holds a blank.
END = b" "
#: Distinct words a worker remembers, and those whose token ids it remembers, which take longer to make again.
MEMO_WORDS = 150_000
TOKEN_WORDS = 500_000
#: Bytes of text handled at once inside a task.
CHUNK_BYTES = 2_000_000
TOKEN_CHUNK = 4_000_000


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of an Arrow column as UTF-8 (null: empty), about ``limit`` bytes at a time, each with the place of its first.

    Only the texts of one chunk are Python objects at a time; a text is never cut.
    """
    upto = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(column):
        before = upto[start - 1] if start else 0
        end = min(len(column), int(np.searchsorted(upto, before + limit)) + 1)
        yield start, [text or b"" for text in column.slice(start, end - start).cast(pa.binary()).to_pylist()]
        start = end


def release() -> None:
    """Give free memory of this process, Arrow's and the C library's, back to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


Batches = Iterator[pa.RecordBatch]


def releasing(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function for ``mapInArrow`` whose worker holds no free memory when the task has ended.

    Workers wait for tasks of other stages, whose memory theirs adds to.
    """

    def run(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            release()

    return run


class _Numbered(dict):
    """Number of a word; new words are noted in ``fresh``."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class WordMemo:
    """Values computed once per distinct word and worker, for a bounded number of words.

    Beyond ``limit`` distinct words, only those met more than once since the last time are kept, the most frequent
    first, and at most half of the limit; a forgotten word is computed again when it comes back.
    """

    def __init__(self, limit: int = MEMO_WORDS) -> None:
        self.limit = limit
        self.numbers = _Numbered()
        self.met = np.zeros(0, np.int64)

    def compute(self, words: list[bytes]) -> None:
        """Append the values of new words."""
        raise NotImplementedError

    def keep(self, numbers: np.ndarray) -> None:
        """Keep the values of these words only, in this order."""
        raise NotImplementedError

    def look_up(self, words: Iterable[bytes], count: int) -> np.ndarray:
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int64, count)
        if self.numbers.fresh:
            self.compute(self.numbers.fresh)
            self.numbers.fresh = []
        met = np.bincount(numbers, minlength=len(self.numbers))
        met[: len(self.met)] += self.met
        self.met = met
        return numbers

    def trim(self) -> None:
        """Call when the numbers of a chunk are no longer used."""
        if len(self.numbers) <= self.limit:
            return
        often = np.flatnonzero(self.met > 1)
        if len(often) > self.limit // 2:
            often = np.sort(often[np.argsort(-self.met[often], kind="stable")[: self.limit // 2]])
        words = list(self.numbers)
        self.numbers.clear()
        for i in often.tolist():
            self.numbers[words[i]] = len(self.numbers)
        self.keep(often)
        self.met = np.ones(len(often), np.int64)


def folded(text: bytes) -> bytes:
    """A to Z in lower case, where a tokenizer that ignores case cannot tell.

    Texts with combining marks, which may compose with one case of a letter only, and with what looks like a special
    token are left as they are.
    """
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text
    return text.lower()


def packed(ids: Iterable[int]) -> bytes:
    """Ids in 32 bits each."""
    return array("I", ids).tobytes()


class TokenEncoder(WordMemo):
    """Token ids of whole texts, by a tokenizer that ignores case, drops white space and never merges across it.

    For such a tokenizer the ids of a text are those of its words one after the other, so the tokenizer runs once per
    distinct word. Text is cut at ASCII white space only; any other white space stays in the word and is left to the
    tokenizer.
    """

    def __init__(self, path: str, end_id: int | None = None, limit: int = TOKEN_WORDS) -> None:
        super().__init__(limit)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.runs: dict[bytes, bytes] = {}
        self.mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if self.mark:
            for token, number in self.tokenizer.get_vocab().items():
                self.ends_word[number] = token.endswith(self.mark)
        self.end = [] if end_id is None else [END]
        self.pool = np.zeros(0, np.uint32)
        self.sizes = np.zeros(0, np.int64)
        self.firsts = np.zeros(0, np.int64)
        self.end_id = end_id

    def _append(self, ids: list[bytes]) -> None:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        self.firsts = np.concatenate([self.firsts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), np.uint32)])

    def compute(self, words: list[bytes]) -> None:
        """Most words are a run of letters and perhaps a run of signs, which the tokenizer splits there.

        Both runs are looked up on their own, so that case and punctuation do not make a word new. Runs of ASCII
        letters go to the tokenizer's model as they are; other letters go through the whole tokenizer, many at once.
        """
        runs, split = self.runs, LETTERS_SIGNS.fullmatch
        if self.end:
            runs[END] = packed([self.end_id])
        parts: list[tuple[bytes, bytes] | None] = []
        plain, letters, signs, whole = set(), set(), set(), []
        for word in words:
            if word == END:
                part = (END, b"")
            elif self.mark and (found := split(word)):
                run = found[1].lower()
                part = (word if run == word else run, found[2])  # one object is held, not two that are equal
                if part[0] not in runs:
                    plain.add(part[0])
            else:
                core = word.rstrip(SIGNS)
                text = core.decode("utf-8", "replace")
                if not (self.mark and text.lower().isalpha()):
                    parts.append(None)
                    whole.append(word.decode("utf-8", "replace"))
                    continue
                part = (core, word[len(core) :])
                if core not in runs:
                    letters.add(core)
            if part[1] and part[1] not in runs:
                signs.add(part[1])
            parts.append(part)
        tokenize = self.tokenizer.model.tokenize
        for run in plain:
            runs[run] = packed(token.id for token in tokenize(run.decode()))
        self._letters(list(letters))
        self._one_by_one([run for run in letters | signs if run not in runs])
        apart = iter(self.tokenizer.encode_batch_fast(whole, add_special_tokens=False))
        self._append([(runs[p[0]] + runs[p[1]] if p[1] else runs[p[0]]) if p else packed(next(apart).ids) for p in parts])
        if len(runs) > self.limit:
            self.runs = {}

    def _letters(self, runs: list[bytes], at_once: int = 200) -> None:
        """Runs of letters, separated by blanks; the token that ends a run tells where."""
        groups = [runs[i : i + at_once] for i in range(0, len(runs), at_once)]
        found = self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, found):
            ids = np.array(encoding.ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(group):  # else some run is more than a run to the tokenizer
                for run, own in zip(group, np.split(ids, ends[:-1])):
                    self.runs[run] = own.tobytes()

    def _one_by_one(self, runs: list[bytes]) -> None:
        texts = [run.decode() for run in runs]
        for run, encoding in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            self.runs[run] = packed(encoding.ids)

    def keep(self, numbers: np.ndarray) -> None:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        self.pool = self.pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.firsts[numbers] - (ends - sizes), sizes)]
        self.sizes, self.firsts = sizes, ends - sizes

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text; the end id is counted."""
        words: list[bytes] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = folded(text).split() + self.end
            counts[i] = len(own)
            words += own
        numbers = self.look_up(words, len(words))
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total, dtype=np.int32)  # a chunk has far fewer ids than that takes
        places += np.repeat((self.firsts[numbers] - (ends - sizes)).astype(np.int32), sizes)
        ids = self.pool[places]
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        self.trim()
        return ids, np.diff(upto)


@functools.lru_cache(maxsize=2)
def token_encoder(path: str, end_id: int | None = None) -> TokenEncoder:
    """The encoder of this Python worker, which keeps it and the words it met from task to task."""
    return TokenEncoder(path, end_id)
