"""Token counts that follow edits without counting a text again.

For each document the counts of its pre-tokens are the leaves of a segment tree,
in blocks; inner nodes hold the characters and tokens below them. An edit descends
to the characters it touches, pre-tokenises from a few pre-tokens before them until
a boundary falls on an old one again, and updates the sums on the way up. A match of
the pattern depends only on the text from its start on, so beyond that boundary all
pre-tokens are as they were.

``count_tokens`` builds and edits the trees of a row within the row; no text is shuffled.
``count_trees`` returns them as a table to be stored, and ``edit_trees`` takes a batch
of edits to it: of the edited documents it reads the stored blocks, reads again what an
edit touches, and returns their new blocks. Positions count
characters (code points), as Spark's ``length`` does.

Defined cases: a null text is empty; a null list of edits is none; an edit with a
null position is left out, a null replacement deletes; positions beyond the text are
its end, and a stop before the start is the start; edits apply in their order, each
to the text as the earlier ones left it; repeated rows are counted each; an empty
table stays empty. Other columns are kept; the columns added must not be there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.bpe import Merges, replay, texts_of
from rollbook.llm.common import pieces

BLOCK = 64
#: Pre-tokens before an edit that are read again, and the least read again after it.
CONTEXT = 3
AHEAD = 8
CHUNK_BYTES = 12_000_000
MEMORY = 400_000

ADDED = [("n_tokens", T.LongType()), ("n_tokens_edited", T.LongType()), ("n_edits", T.IntegerType()), ("n_reread", T.LongType())]


class CountTree:
    """A segment tree over blocks of pre-tokens, with characters and tokens as sums."""

    def __init__(self, words: list[str], split: Callable[[str], list[str]], count: Callable[[str], int]):
        self._split, self._count = split, count
        self.reread = 0
        self._build([words[i : i + BLOCK] for i in range(0, len(words), BLOCK)] or [[]])

    @classmethod
    def kept(cls, blocks: list[dict], split: Callable[[str], list[str]], count: Callable[[str], int]) -> CountTree:
        """The tree of stored blocks; their sums are taken as they are."""
        tree = cls([], split, count)
        sums = iter([(block["chars"], block["tokens"]) for block in blocks] or [(0, 0)])
        tree._sums = lambda _: next(sums)
        tree._build([block["words"] for block in blocks] or [[]])
        del tree._sums
        return tree

    def blocks(self) -> list[dict]:
        """What is stored: the pre-tokens of each block that has any, with its characters and tokens."""
        sums = zip(self._chars[self._half :], self._tokens[self._half :], self._blocks, strict=False)
        return [{"words": words, "chars": chars, "tokens": tokens} for chars, tokens, words in sums if words]

    def _build(self, blocks: list[list[str]]) -> None:
        self._blocks = blocks
        self._half = 1 << (len(blocks) - 1).bit_length()
        self._chars, self._tokens = [0] * (2 * self._half), [0] * (2 * self._half)
        for at, block in enumerate(blocks):
            self._chars[self._half + at], self._tokens[self._half + at] = self._sums(block)
        for node in range(self._half - 1, 0, -1):
            self._add_up(node)

    def _sums(self, block: list[str]) -> tuple[int, int]:
        return sum(map(len, block)), sum(map(self._count, block))

    def _add_up(self, node: int) -> None:
        self._chars[node] = self._chars[2 * node] + self._chars[2 * node + 1]
        self._tokens[node] = self._tokens[2 * node] + self._tokens[2 * node + 1]

    @property
    def tokens(self) -> int:
        return self._tokens[1]

    @property
    def chars(self) -> int:
        return self._chars[1]

    def text(self) -> str:
        return "".join(word for block in self._blocks for word in block)

    def _find(self, char: int) -> tuple[int, int, int]:
        """Block and number of the pre-token that holds a character, and that pre-token's first character.

        The end of the text counts as a pre-token after the last one.
        """
        if char >= self.chars:
            last = len(self._blocks) - 1
            return last, len(self._blocks[last]), self.chars
        node, start = 1, 0
        while node < self._half:
            node *= 2
            if char >= start + self._chars[node]:
                start += self._chars[node]
                node += 1
        block = node - self._half
        for number, word in enumerate(self._blocks[block]):
            if char < start + len(word):
                return block, number, start
            start += len(word)
        raise AssertionError("the sums do not fit the blocks")

    def _back(self, block: int, number: int, start: int, steps: int) -> tuple[int, int, int]:
        """The pre-token some steps before, or the first one."""
        while steps and (block or number):
            if number:
                number -= 1
                start -= len(self._blocks[block][number])
                steps -= 1
            else:
                block -= 1
                number = len(self._blocks[block])
        return block, number, start

    def _from(self, block: int, number: int) -> Iterator[tuple[int, int, str]]:
        """Pre-tokens from a place on, with the place after each."""
        while block < len(self._blocks):
            words = self._blocks[block]
            while number < len(words):
                number += 1
                yield block, number, words[number - 1]
            block, number = block + 1, 0

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in the place of the characters from ``start`` to ``stop``."""
        start = min(max(start, 0), self.chars)
        stop = min(max(stop, start), self.chars)
        first_block, first, first_char = self._back(*self._find(start), CONTEXT)
        ahead = AHEAD
        while True:
            # Old pre-tokens from the first on: up to the edit's end, then some more.
            old, ends, places, char, beyond = [], [], [], first_char, 0
            for block, number, word in self._from(first_block, first):
                old.append(word)
                char += len(word)
                ends.append(char)
                places.append((block, number))
                beyond += char >= stop
                if beyond > ahead:
                    break
            at_end = char >= self.chars
            text = "".join(old)
            text = text[: start - first_char] + new + text[stop - first_char :]
            moved = len(new) - (stop - start)
            words = self._split(text)
            self.reread += len(words)
            found = self._meet(words, ends, first_char, stop, moved, at_end)
            if found is not None:
                break
            ahead *= 4
        kept, until = found
        self._put(first_block, first, places[until] if until >= 0 else (first_block, first), words[:kept])

    @staticmethod
    def _meet(words: list[str], ends: list[int], char: int, stop: int, moved: int, at_end: bool) -> tuple[int, int] | None:
        """How many new pre-tokens stand for the old ones up to which number; None to read further."""
        if at_end:
            return len(words), len(ends) - 1
        old = {end: number for number, end in enumerate(ends) if end >= stop}
        # The last two may look different with the text that follows.
        for number, word in enumerate(words[:-2]):
            char += len(word)
            if char - moved in old:
                return number + 1, old[char - moved]
        return None

    def _put(self, block: int, number: int, until: tuple[int, int], words: list[str]) -> None:
        """Replace the pre-tokens between two places; all new ones go into the first block."""
        last, stop = until
        rest = self._blocks[last][stop:]
        self._blocks[block] = self._blocks[block][:number] + words + (rest if last == block else [])
        for between in range(block + 1, last):
            self._blocks[between] = []
        if last > block:
            self._blocks[last] = rest
        if len(self._blocks[block]) > 4 * BLOCK:
            words = self._blocks[block]
            cut = [words[i : i + BLOCK] for i in range(0, len(words), BLOCK)]
            self._build([b for b in (*self._blocks[:block], *cut, *self._blocks[block + 1 :]) if b] or [[]])
            return
        changed = set()
        for at in range(block, last + 1):
            self._chars[self._half + at], self._tokens[self._half + at] = self._sums(self._blocks[at])
            changed.add((self._half + at) // 2)
        while changed and 0 not in changed:
            for node in changed:
                self._add_up(node)
            changed = {node // 2 for node in changed}


class _Counter:
    """Token counts of pre-tokens; a bounded number of them is remembered."""

    def __init__(self, ranks: dict[bytes, int]):
        self._merges = Merges(ranks)
        self._known: dict[str, int] = {}

    def learn(self, words: set[str]) -> None:
        if len(self._known) > MEMORY:
            self._known = {}
        new = [w for w in words if w not in self._known]
        if new:
            _, offsets = replay(self._merges, [w.encode("utf-8", "replace") for w in new])
            self._known.update(zip(new, (offsets[1:] - offsets[:-1]).tolist(), strict=True))

    def __call__(self, word: str) -> int:
        found = self._known.get(word)
        if found is None:
            found = self._known[word] = len(self._merges.encode_one(word.encode("utf-8", "replace")))
        return found


def count_tokens(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """Add token counts before and after the edits of a column array<struct<start, stop, text>>.

    ``n_reread`` tells how many pre-tokens the edits made the task read again.
    """
    if clash := {name for name, _ in ADDED} & set(docs.columns):
        raise ValueError(f"the rows have columns {sorted(clash)} already")
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, counter = regex.compile(pattern).findall, None
        for batch in pieces(batches, text, CHUNK_BYTES):
            counter = counter or _Counter(sent.value)
            words = [split(t) for t in texts_of(batch.column(text))]
            counter.learn({w for row in words for w in row})
            rows = []
            for at, changes in enumerate(batch.column(edits).to_pylist()):
                tree = CountTree(words[at], split, counter)
                words[at] = None
                before = tree.tokens
                changes = [e for e in changes or [] if e and e["start"] is not None and e["stop"] is not None]
                for e in changes:
                    tree.replace(e["start"], e["stop"], e["text"] or "")
                rows.append((before, tree.tokens, len(changes), tree.reread))
            columns = zip(*rows, strict=True) if rows else [[]] * len(ADDED)
            made = [pa.array(c, pa.int32() if name == "n_edits" else pa.int64()) for c, (name, _) in zip(columns, ADDED, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *(name for name, _ in ADDED)])

    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, *(T.StructField(*f) for f in ADDED)]))


def with_edits(docs: DataFrame, edits: DataFrame, key: str = "doc_id") -> DataFrame:
    """Attach a table of edits (key, seq, start, stop, text) as the column ``edits``, in order of seq.

    The edits of one document stand in its row; their number is bounded by what one
    document gets.
    """
    lists = edits.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "text"))).alias("edits")
    )
    return docs.join(lists.select(key, F.transform("edits", lambda e: F.struct(e["start"], e["stop"], e["text"])).alias("edits")), key, "left")


# --- trees that are kept from batch to batch ----------------------------------

BLOCKS = T.ArrayType(
    T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("chars", T.LongType()), T.StructField("tokens", T.LongType())])
)
TREE = [("n_tokens", T.LongType()), ("blocks", BLOCKS)]
_ARROW_BLOCKS = pa.list_(pa.struct([("words", pa.list_(pa.string())), ("chars", pa.int64()), ("tokens", pa.int64())]))


def count_trees(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, blocks): the tree of every document, to be stored and edited batch by batch.

    The blocks hold the text as well, as the pre-tokens in order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, counter = regex.compile(pattern).findall, None
        for batch in pieces(batches, text):
            counter = counter or _Counter(sent.value)
            words = [split(t) for t in texts_of(batch.column(text))]
            counter.learn({w for row in words for w in row})
            trees = [CountTree(row, split, counter) for row in words]
            yield _tree_rows(key, batch.column(key), trees)

    rows = docs.select(key, F.col(text).cast("string").alias(text))
    return rows.mapInArrow(task, T.StructType([rows.schema[key], *(T.StructField(*f) for f in TREE)]))


def _tree_rows(key: str, keys: pa.Array, trees: list[CountTree], *more: pa.Array, names: tuple[str, ...] = ()) -> pa.RecordBatch:
    made = [pa.array([tree.tokens for tree in trees], pa.int64()), pa.array([tree.blocks() for tree in trees], _ARROW_BLOCKS)]
    return pa.RecordBatch.from_arrays([keys, *made, *more], [key, "n_tokens", "blocks", *names])


def edit_trees(trees: DataFrame, edits: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, blocks, n_reread): the edited trees alone, which take the place of the stored ones.

    ``edits`` is a table (key, seq, start, stop, text). Trees of other documents are only
    joined against, and not opened; a store laid out by a hash of the key need not
    even read those of other parts. Edits of documents without a tree are left out.
    """
    edited = with_edits(trees.select(key, "blocks"), edits, key).where(F.col("edits").isNotNull())
    sent = trees.sparkSession.sparkContext.broadcast(ranks)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, counter = regex.compile(pattern).findall, None
        for whole in batches:
            counter = counter or _Counter(sent.value)
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                found = []
                for blocks, changes in zip(batch.column("blocks").to_pylist(), batch.column("edits").to_pylist(), strict=True):
                    tree = CountTree.kept(blocks, split, counter)
                    for e in changes:
                        if e["start"] is not None and e["stop"] is not None:
                            tree.replace(e["start"], e["stop"], e["text"] or "")
                    found.append(tree)
                yield _tree_rows(key, batch.column(key), found, pa.array([tree.reread for tree in found], pa.int64()), names=("n_reread",))

    return edited.mapInArrow(task, T.StructType([trees.schema[key], *(T.StructField(*f) for f in TREE), T.StructField("n_reread", T.LongType())]))


def text_of_tree() -> Column:
    """The text that the blocks of a tree hold."""
    return F.array_join(F.flatten(F.transform("blocks", lambda block: block["words"])), "")
