"""Token counts of every prefix of a text, by dynamic programming over prefixes."""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from operator import sub

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremeld.llm.common import chunks, settle, table
from faremeld.llm.word_ids import PLAIN, VOCABULARY, byte_letters

LIMIT = 2048
#: Items, pre-tokens and pairs of tokens of a generation that a worker remembers.
REMEMBERED = 200_000

# The vocabulary's contractions; each is a pre-token of its own.
SHORT, PAIRS = "stmd", {"r": "e", "v": "e", "l": "l"}


#: Marks that form a pre-token of their own after a word.
MARKS = ".,;:!?$&*%#()+-"
#: Pre-tokens of printable ASCII text without quotes.
ASCII_PARTS = re.compile("[A-Za-z]+|[0-9]|[^A-Za-z0-9 ]+")


class Lately:
    """Remembers what was asked for lately: two generations, of which the older goes when the younger is full."""

    def __init__(self) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes | None:
        if (found := self.new.get(key)) is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.new) >= REMEMBERED:
            self.old, self.new = self.new, {}
        self.new[key] = value


class Merges:
    """Which tokens can stand next to each other, by the vocabulary's own merges.

    A row of tokens is a text's encoding exactly if each neighbouring pair is
    the encoding of the two tokens' joined text. `inner` tokens do not end a
    pre-token, `final` ones do and carry the end mark.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.end = model["end_of_word_suffix"]
        self.final_model, self.inner_model = self.tokenizer.model, BPE(vocab=model["vocab"], merges=[tuple(m) for m in model["merges"]])
        self.final = {t.removesuffix(self.end) for t in model["vocab"] if t.endswith(self.end)}
        self.inner = {t for t in model["vocab"] if not t.endswith(self.end)}
        self.longest = max(map(len, self.inner | self.final))
        #: The tokens by their letters from the last to the first; at their ends, 1 for inner, 2 for final, 3 for both.
        self.ends: dict = {}
        for token in self.inner | self.final:
            node = self.ends
            for letter in reversed(token):
                node = node.setdefault(letter, {})
            node[""] = token, (token in self.inner) + 2 * (token in self.final)
        #: For inner and final tokens: what each can follow, as far as asked.
        self.joins: tuple[dict, dict] = ({}, {})
        self.states: dict[str, tuple[str, int, int]] = {"": ("", 0, 0)}

    def fits(self, left: str, right: str, final: bool) -> bool:
        """Whether `right` may follow `left`; an empty `left` is the pre-token's start."""
        joins = self.joins[final]
        if (known := joins.get((left, right))) is None:
            found = [t.value for t in (self.final_model if final else self.inner_model).tokenize(left + right)]
            known = found == [*([left] if left else []), right + self.end * final]
            if len(joins) >= 2 * REMEMBERED:
                joins.clear()
            joins[left, right] = known
        return known

    def totals(self, symbols: str) -> list[int]:
        """Tokens of each prefix of a pre-token, were it to end there.

        `states` holds (last token, tokens, tokens if the pre-token ends here)
        of prefixes; words that begin alike share them. Exactly one token can be
        the last of a prefix: the one that fits the state before it.
        """
        states, ends, known = self.states, self.ends, len(symbols)
        if len(states) >= 3 * REMEMBERED:
            states.clear()
            states[""] = ("", 0, 0)
        inner_joins, final_joins = self.joins
        while symbols[:known] not in states:
            known -= 1
        before = [states[symbols[:at]] for at in range(known + 1)]
        for at in range(known + 1, len(symbols) + 1):
            inner = final = None
            node, start = ends, at
            while start and (node := node.get(symbols[start - 1])) is not None:
                start -= 1
                if "" in node:
                    token, kind = node[""]
                    last, count, _ = before[start]
                    pair = last, token
                    if inner is None and kind != 2:
                        fits = inner_joins.get(pair)
                        if fits or fits is None and self.fits(last, token, False):
                            inner, counted = token, count + 1
                            if final is not None:
                                break
                    if final is None and kind != 1:
                        fits = final_joins.get(pair)
                        if fits or fits is None and self.fits(last, token, True):
                            final = count + 1
                            if inner is not None:
                                break
            before.append((inner, counted, final))
            states[symbols[:at]] = before[-1]
        return [final for _, _, final in before[1:]]


class Run:
    """A pre-token that grows: for each of its prefixes, the last token and the number of tokens."""

    __slots__ = ("merges", "tail", "last", "count")

    def __init__(self, merges: Merges, symbols: str = "") -> None:
        self.merges, self.tail, self.last, self.count = merges, "", [""], [0]
        self.push(symbols)

    def _step(self, tail: str, at: int, tokens: set[str], final: bool) -> tuple[str, int]:
        """The only token that can end the prefix of `at` symbols, and the prefix's count."""
        for size in range(min(self.merges.longest, at), 0, -1):
            token = tail[-size:]
            if token in tokens and self.merges.fits(self.last[at - size], token, final):
                return token, self.count[at - size] + 1
        raise ValueError(f"no token of the vocabulary ends {tail!r}")

    def push(self, symbols: str) -> None:
        for symbol in symbols:
            self.tail = (self.tail + symbol)[-self.merges.longest :]
            token, count = self._step(self.tail, len(self.last), self.merges.inner, False)
            self.last.append(token)
            self.count.append(count)

    def total(self) -> int:
        """The tokens of the run, were it to end here."""
        return self._step(self.tail, len(self.last) - 1, self.merges.final, True)[1]

    def mark(self) -> tuple[str, int]:
        return self.tail, len(self.last)

    def back(self, mark: tuple[str, int]) -> None:
        self.tail, size = mark
        del self.last[size:], self.count[size:]


class Growing:
    """A normalised text that grows by characters and knows its number of tokens after each."""

    def __init__(self, table: PrefixTable) -> None:
        self.table, self.base, self.kind, self.run, self.quote = table, 0, "", None, None

    def count(self) -> int:
        return self.base + (self.run.total() if self.run else 0)

    def _close(self) -> None:
        self.base, self.run, self.kind = self.count(), None, ""

    def add(self, char: str) -> None:
        kind, symbols = self.table.kind(char), self.table.symbols(char)
        quote, self.quote = self.quote, None
        if self.kind == "'" and char in SHORT:
            self.run.push(symbols)
            self.kind = "whole"
        elif quote and char == PAIRS[quote[1]]:  # the letter after the quote belonged to a contraction
            self.base, (letter, run) = quote[0], (quote[1], Run(self.table.merges, self.table.symbols("'")))
            run.push(self.table.symbols(letter) + symbols)
            self.run, self.kind = run, "whole"
        elif kind == "space":
            self._close()
        elif self.kind == "'" and char in PAIRS:
            before = self.base
            self._close()
            self.run, self.kind, self.quote = Run(self.table.merges, symbols), "letter", (before, char)
        elif kind == self.kind and kind != "number" or kind == "other" and self.kind == "'":
            self.run.push(symbols)
            self.kind = kind
        else:
            self._close()
            self.run, self.kind = Run(self.table.merges, symbols), "'" if char == "'" else kind

    def mark(self) -> tuple:
        return self.base, self.kind, self.run, self.quote, self.run and self.run.mark()

    def back(self, mark: tuple) -> None:
        self.base, self.kind, self.run, self.quote, at = mark
        if self.run:
            self.run.back(at)


class PrefixTable(dict):
    """Maps an item (what stands between blanks) to one byte per code point: by how much each changes the count.

    A prefix's tokens are those of its pre-tokens. The last one may be cut, so
    its count is the one of its cut form, which the vocabulary ends differently.
    Each item is worked through once, whatever number of prefixes it has.
    """

    def __init__(self, vocabulary: str | None = None) -> None:
        super().__init__()
        if vocabulary is None:
            import public_tokenizers

            vocabulary = public_tokenizers.path(VOCABULARY)
        self.merges = Merges(vocabulary)
        self.tokenizer = self.merges.tokenizer
        self.bytes = byte_letters()
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")")
        self.joining = {chr(int(d.split()[1], 16)) for c in map(chr, range(0x110000)) if (d := unicodedata.decomposition(c)) and d[0] != "<" and " " in d}
        self.joining |= set(map(chr, [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]))
        self.kinds: dict[str, str] = {}
        self.words, self.before = Lately(), {}

    @classmethod
    def of_worker(cls, vocabulary: str | None) -> PrefixTable:
        """The table of this Python worker, which learns from all its tasks what each word's prefixes count."""
        kept = getattr(cls, "_kept", None)
        if kept is None or kept[0] != vocabulary:
            cls._kept = kept = vocabulary, cls(vocabulary)
        return kept[1]

    def symbols(self, text: str) -> str:
        return "".join([self.bytes[b] for b in text.encode()])

    def kind(self, char: str) -> str:
        """How the pre-tokeniser takes a character: as part of a run of letters or others, alone, or as space."""
        if (known := self.kinds.get(char)) is None:
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str
            if not split(char):
                known = "space"
            elif len(split("a" + char)) == 1:
                known = "letter"
            else:
                known = "number" if len(split(char + char)) == 2 else "other"
            self.kinds[char] = known
        return known

    def clusters(self, text: str) -> Iterator[str]:
        """Pieces of the text that normalisation treats apart from each other."""
        start = 0
        for i in range(1, len(text) + 1):
            if i == len(text) or not unicodedata.combining(text[i]) and text[i] not in self.joining:
                yield text[start:i]
                start = i

    def general(self, item: str) -> list[int]:
        """Counts after each code point of any text. Special strings are tokens once they are whole."""
        out, base, parts = [], 0, self.special.split(item)
        for ordinary, special in zip(parts[::2], [*parts[1::2], ""]):
            growing = Growing(self)
            normal = self.tokenizer.normalizer.normalize_str
            for cluster in self.clusters(ordinary) if ordinary else ():
                mark = growing.mark()
                for size in range(1, len(cluster) + 1):
                    for char in normal(cluster[:size]):
                        growing.add(char)
                    out.append(base + growing.count())
                    if size < len(cluster):
                        growing.back(mark)
            whole = growing.count() + 1
            for char in special[:-1]:
                growing.add(char)
                out.append(base + growing.count())
            if special:
                out.append(base + whole)
                base += whole
        return out

    def pre_token(self, letters: str) -> bytes:
        """The changes along a pre-token whose letters stand for themselves."""
        if (found := self.words.get(letters)) is None:
            if len(letters) > 64:  # too long to name each of its prefixes
                run, counts = Run(self.merges), []
                for letter in letters:
                    run.push(self.symbols(letter))
                    counts.append(run.total())
            elif letters.isascii():
                counts = self.merges.totals(letters)
            else:
                counts = self.merges.totals(self.symbols(letters))
                counts = [counts[at - 1] for at in itertools.accumulate(len(letter.encode()) for letter in letters)]
            found = array("b", map(sub, counts, [0, *counts])).tobytes()
            self.words.put(letters, found)
        return found

    def __missing__(self, item: str) -> bytes:
        """Raises OverflowError if a change needs more than a byte. What follows a pre-token doesn't change its own counts."""
        lower = item.lower()
        if (found := self.before.get(item)) is not None:
            pass
        elif (found := self.words.get(core := lower.rstrip(MARKS))) is not None and core[-1].isalnum():
            if marks := lower[len(core) :]:
                found += self.pre_token(marks)
        elif m := PLAIN.fullmatch(item):
            letters, marks = m.groups()
            found = self.pre_token(letters.lower())
            if marks:
                found += self.pre_token(marks)
        elif item.isascii() and item.isprintable() and "'" not in item and "<|" not in item:
            found = b"".join(map(self.pre_token, ASCII_PARTS.findall(lower)))
        else:
            counts = self.general(item)
            found = array("b", map(sub, counts, [0, *counts])).tobytes()
        if len(item) <= 64:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[item] = found
        return found

    def changes(self, text: str) -> np.ndarray:
        """By how much each code point of a text changes the number of tokens; their running sum is every prefix's count."""
        items = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        try:
            return np.frombuffer(b"\0".join(map(self.__getitem__, items)), np.int8)
        except OverflowError:
            found = [np.diff(np.array([0, *self.general(x)], np.int32)) for x in items]
            return np.concatenate([part for x in found for part in (np.zeros(1, np.int32), x)])[1:].astype(np.int32)


STORED = "doc_id long, n_tokens long, n_chars long, changes binary"


def prefix_counts(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_chars, changes) of every row of (doc_id, text): the stored table.

    `changes` holds one signed number per code point, one byte wide, or four
    where a text needs it; the sum of the first k is the exact number of tokens
    of the prefix of k code points, as the vocabulary's library encodes it,
    without added special tokens. A null text is empty, has no tokens and no
    changes; null doc_ids stay; repeated rows are rows of their own; other
    columns are not read. Work and memory of a text grow with its length.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = PrefixTable.of_worker(vocabulary)
        for batch in batches:
            ids, texts = batch["doc_id"].astype("Int64"), [t or "" for t in batch["text"]]
            for part in chunks(texts):
                found = [table.changes(t) for t in texts[part]]
                yield pd.DataFrame({"doc_id": ids.iloc[part].array, "n_tokens": [int(x.sum(dtype=np.int64)) for x in found], "n_chars": [len(x) for x in found], "changes": [x.tobytes() for x in found], "n_bytes": batch["n_bytes"].iloc[part].to_numpy()})

    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.octet_length(text).cast("long").alias("n_bytes")).mapInPandas(run, STORED + ", n_bytes long")


def _stored(changes: bytes, n_chars: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(changes, np.int8 if len(changes) == n_chars else np.int32), dtype=np.int64)


def tokens_of_prefix(chars: Column | str) -> Column:
    """Tokens of the first `chars` code points, from a stored row; the whole text's if there are fewer, 0 below one."""

    def look_up(changes: pd.Series, n_chars: pd.Series, asked: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(k) else int(_stored(c, n)[min(int(k), n) - 1]) if n and k > 0 else 0 for c, n, k in zip(changes, n_chars, asked)], dtype="Int64")

    return F.pandas_udf(look_up, "long")("changes", "n_chars", chars)


def longest_prefix(limit: Column | int) -> Column:
    """Code points of the longest prefix of a stored row that has at most `limit` tokens.

    Counts may fall from one prefix to the next, so this is the last that fits, not the first that doesn't.
    """

    def look_up(changes: pd.Series, n_chars: pd.Series, limits: pd.Series) -> pd.Series:
        out = []
        for c, n, k in zip(changes, n_chars, limits):
            fits = np.flatnonzero(_stored(c, n) <= k) if not pd.isna(k) and k >= 0 else ()
            out.append(int(fits[-1]) + 1 if len(fits) else 0)
        return pd.Series(out, dtype="int64")

    return F.pandas_udf(look_up, "long")("changes", "n_chars", F.lit(limit) if isinstance(limit, int) else limit)


def op11_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of whole texts, and where a text over the limit is to be cut, from the stored prefix counts."""
    stored = settle(prefix_counts(table(spark, sf_dir, "documents")))
    over = F.col("n_tokens") > LIMIT
    given = ["doc_id", "n_bytes", "n_tokens", over.alias("over_limit")]
    cut = stored.where(over).select(*given, longest_prefix(LIMIT).alias("kept_chars"))
    return cut.unionByName(stored.where(~over).select(*given, F.col("n_chars").alias("kept_chars")))
