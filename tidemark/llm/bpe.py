"""Byte-level BPE as Spark expressions: ranked merges folded over distinct words.

A word is a string with one character per token. A byte is the character of its value, any longer
token the character 0x10000 + rank; so code point order is rank order, the best merge is the least
character, and applying it everywhere is one ``replace``, which goes from the left as the merges do.
The rank map, from two neighbouring characters to the merged one, is a literal: an array of small
maps, addressed by the pair's checksum, because Spark searches a map from end to end.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST = 0x10000
BUCKETS = 1 << 15
# Words of up to so many bytes are merged place by place.
SHORT = 128


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _char(token: bytes, rank: int) -> str:
    return token.decode("latin-1") if len(token) == 1 else chr(FIRST + rank)


def early_parts(ranks: dict[bytes, int]) -> set[bytes]:
    """Tokens that are part of a token of lower rank. Merging all places of any other token at once is
    the same as merging them one by one: no pair that it makes can come before the next of them."""
    early = set()
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = token[:i], token[i:]
            if a in ranks and b in ranks:
                early.update(part for part in (a, b) if len(part) > 1 and ranks[part] > rank)
    return early


class Merges:
    """The expressions for one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self._bytes = F.array(*(F.lit(ranks[bytes([b])]) for b in range(256)))

    @functools.cached_property
    def _table(self) -> Column:
        ranks = self.ranks
        table: list[dict[str, str]] = [{} for _ in range(BUCKETS)]

        def put(key: str, merged: str) -> None:
            table[zlib.crc32(key.encode("utf-8")) % BUCKETS][key] = merged

        for token, rank in ranks.items():
            if len(token) > 1:
                # A word that is a token is that token, whatever the merges would give.
                put(token.decode("latin-1"), _char(token, rank))
                for i in range(1, len(token)):
                    a, b = token[:i], token[i:]
                    if a in ranks and b in ranks:
                        put(_char(a, ranks[a]) + _char(b, ranks[b]), _char(token, rank))
        return F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "array<map<string,string>>")

    @functools.cached_property
    def _early(self) -> list[str]:
        return [_char(t, self.ranks[t]) for t in sorted(early_parts(self.ranks))] or [""]

    def _merged(self, table: Column, a: Column, b: Column) -> Column:
        """The token that two neighbours make; else null."""
        return self._found(table, F.concat(a, b))

    def _found(self, table: Column, key: Column) -> Column:
        return F.get(table, F.pmod(F.crc32(key), F.lit(BUCKETS)).cast("int"))[key]

    def _pairs(self, table: Column, chars: Column) -> Column:
        n = F.size(chars) - 1
        return F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n),
                          lambda a, b: self._merged(table, a, b))

    def _one_merge(self, table: Column, state: Column) -> Column:
        """The leftmost best pair merged. Only the two pairs beside it have to be looked up again."""
        chars, merged = state["chars"], state["merged"]

        def at_place(place: Column) -> Column:
            best = F.get(merged, place - 1)
            left, right = F.get(chars, place - 2), F.get(chars, place + 1)
            n = F.size(chars)
            beside = F.concat(
                F.when(place > 1, F.array(self._merged(table, left, best))).otherwise(no_chars()),
                F.when(place < n - 1, F.array(self._merged(table, best, right))).otherwise(no_chars()))
            return F.struct(
                F.concat(F.slice(chars, F.lit(1), place - 1), F.array(best),
                         F.slice(chars, place + 2, n)).alias("chars"),
                F.concat(F.slice(merged, F.lit(1), F.greatest(place - 2, F.lit(0))), beside,
                         F.slice(merged, place + 2, n)).alias("merged"))

        # Once nothing is left to merge, no pairs are kept, and the rounds left cost nothing.
        return F.when(F.size(merged) == 0, state).otherwise(_let(
            F.array_position(merged, F.array_min(merged)).cast("int"),
            lambda place: F.when(place > 0, at_place(place)).otherwise(
                F.struct(chars.alias("chars"), no_chars().alias("merged")))))

    def _fold_short(self, table: Column, start: Column) -> Column:
        chars = F.split(start, "")
        return F.aggregate(
            F.sequence(F.lit(1), F.length(start)),
            F.struct(chars.alias("chars"), self._pairs(table, chars).alias("merged")),
            lambda state, _: self._one_merge(table, state),
            lambda state: state["chars"])

    def _fold_long(self, table: Column, start: Column) -> Column:
        """The same for long words: one replacement for all places of the best pair, where that is
        safe, so that a run of one character takes few rounds."""
        def step(word: Column) -> Column:
            def use(merged: Column) -> Column:
                def best_of(best: Column) -> Column:
                    at = F.array_position(merged, best).cast("int")
                    pair = F.substring(word, at, F.lit(2))
                    one = F.concat(F.substring(word, F.lit(1), at - 1), best,
                                   F.substring(word, at + 2, F.length(word)))
                    makers = F.array_distinct(F.filter(
                        F.transform(merged, lambda m, i: F.when(
                            m == best, F.substring(word, i + 1, F.lit(2)))), lambda p: p.isNotNull()))
                    return F.when(~best.isin(self._early) & (F.size(makers) == 1),
                                  F.replace(word, pair, best)).otherwise(one)

                return _let(F.array_min(merged), best_of)

            return _let(self._pairs(table, F.split(word, "")), use)

        def round_(state: Column, _: Column) -> Column:
            return F.when(state["done"] | (F.length(state["word"]) < 2), state).otherwise(
                _let(step(state["word"]), lambda new: F.struct(
                    F.coalesce(new, state["word"]).alias("word"), new.isNull().alias("done"))))

        return F.aggregate(
            F.sequence(F.lit(1), F.length(start)),
            F.struct(start.alias("word"), F.lit(False).alias("done")),
            round_,
            lambda state: F.split(state["word"], ""))

    def encode_words(self, words: Column) -> Column:
        """The ids of each of an array of words, as array<array<int>>. Empty words have none."""
        def of(table: Column, word: Column) -> Column:
            latin = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
            whole = self._found(table, latin)
            chars = F.when(F.length(latin) < 2, F.split(latin, "")).when(
                whole.isNotNull(), F.array(whole)).when(
                F.length(latin) <= SHORT, self._fold_short(table, latin)).otherwise(
                self._fold_long(table, latin))
            return F.transform(F.filter(chars, lambda c: c != ""), lambda c: _let(
                F.ascii(c), lambda v: F.when(v >= FIRST, v - FIRST).otherwise(F.get(self._bytes, v))))

        return _let(self._table, lambda table: F.transform(words, lambda word: of(table, word)))


def no_chars() -> Column:
    return F.array().cast("array<string>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, computed once: an expression used twice would be computed twice."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
