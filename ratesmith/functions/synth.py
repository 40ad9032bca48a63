"""Synthetic columns drawn from a hash of the row's key.

Every draw is a function of the key columns, the seed and the number of the draw. A task that is
run again after a lost executor produces the same values, which a stateful generator would not.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Mapping, Sequence
from copy import copy
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, functions as F

# Fixed character sets.
_WORD = string.ascii_letters + string.digits + "_"
ALPHABETS = {
    "printable": string.printable,
    "letters": string.ascii_letters,
    "uppercase": string.ascii_uppercase,
    "lowercase": string.ascii_lowercase,
    "digits": string.digits,
    "punctuation": string.punctuation,
    "nondigits": string.ascii_letters + string.punctuation,
    "nonletters": string.digits + string.punctuation,
    "whitespace": string.whitespace,
    "nonwhitespace": string.printable.strip(),
    "normal": string.ascii_letters + string.digits + " ",
    "word": _WORD,
    "nonword": "".join(ch for ch in string.printable if ch not in _WORD),
    "unambiguous": "".join(
        ch for ch in string.ascii_letters + string.digits if ch not in "0O1lI"
    ),
    "postalsafe": string.ascii_letters + string.digits + " .-#/",
    "urlsafe": string.ascii_letters + string.digits + "-._~",
    "domainsafe": string.ascii_letters + string.digits + "-",
}

_UNIT = 2.0 ** -53

# Longest text drawn without a lambda per character, and the characters put into one whole number.
_UNROLLED, _BLOCK = 256, 8


def _operand(value: int | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


class Draws:
    """Independent random columns for the rows identified by the key columns."""

    def __init__(self, *keys: str | Column, seed: int = 0, **alphabets: str):
        self._keys = [F.col(key) if isinstance(key, str) else key for key in keys]
        self._seed = seed
        self._drawn = [0]  # shared with the draws of places
        self._places: tuple[Column, ...] = ()
        self._alphabets = {**ALPHABETS, **alphabets}

    def seed(self, seed: int) -> None:
        """Start again with another seed."""
        self._seed, self._drawn[0] = seed, 0

    @property
    def count(self) -> int:
        """Draws made so far; setting it back repeats them."""
        return self._drawn[0]

    @count.setter
    def count(self, number: int) -> None:
        self._drawn[0] = number

    def at(self, place: Column) -> Draws:
        """Draws of their own for every place of an array, for use inside a lambda."""
        inner = copy(self)
        inner._places = (*self._places, place)
        return inner

    def add_alphabet(self, name: str, characters: str) -> None:
        self._alphabets[name] = characters

    def alphabet(self, name: str) -> str:
        return self._alphabets[name]

    def _hash(self, *more: Column) -> Column:
        self._drawn[0] += 1
        return F.xxhash64(*self._keys, F.lit(self._seed), F.lit(self._drawn[0]), *self._places, *more)

    def uniform(self) -> Column:
        """Uniform number in [0, 1)."""
        return F.shiftrightunsigned(self._hash(), 11).cast("double") * _UNIT

    def weighted(self, weights: Mapping) -> Column:
        """A value drawn with the given weights; one uniform number decides between all."""
        point = self.uniform() * float(sum(weights.values()))
        options = list(weights)
        chain = F
        for option, bound in zip(options[:-1], accumulate(weights.values())):
            chain = chain.when(point < float(bound), F.lit(option))
        return chain.otherwise(F.lit(options[-1])) if len(options) > 1 else F.lit(options[0])

    def choice(self, values: Sequence) -> Column:
        """A value drawn with equal weights."""
        place = (F.pmod(self._hash(), F.lit(len(values))) + 1).cast("int")
        if all(isinstance(value, str) and len(value) == 1 for value in values):
            return F.substring(F.lit("".join(values)), place, 1)
        return F.element_at(F.array(*[F.lit(value) for value in values]), place)

    def integer(self, start: int | str | Column, stop: int | str | Column) -> Column:
        """A whole number from start to stop, both included; text names a column."""
        low, high = _operand(start).cast("bigint"), _operand(stop).cast("bigint")
        return (low + F.pmod(self._hash(), high - low + 1)).cast("int")

    def shuffle(self, array: str | Column) -> Column:
        """The elements of an array in random order."""
        items = F.col(array) if isinstance(array, str) else array
        base = self._hash()
        ranked = F.transform(
            items, lambda item, place: F.struct(F.xxhash64(base, place).alias("rank"),
                                                place.alias("place"), item.alias("item"))
        )
        return F.transform(F.sort_array(ranked), lambda entry: entry["item"])

    def text(
        self,
        alphabet: str | Sequence[str],
        start: int | None = None,
        stop: int | None = None,
        include: str | Sequence[str] = "",
        exclude: str | Sequence[str] = "",
    ) -> Column:
        """A string of characters of an alphabet, given by name or as its characters.

        Its length is 1 to 10, exactly `start`, or from `start` to `stop`. Every character of
        `include` occurs in it, within that length, and none of `exclude`.
        """
        named = isinstance(alphabet, str) and alphabet in self._alphabets
        pool = [ch for ch in (self._alphabets[alphabet] if named else alphabet)
                if ch not in exclude]
        if start is None:
            start, stop = 1, 10
        stop = start if stop is None else stop
        if not pool or start > stop or start < len(include):
            raise ValueError("no such string: check alphabet, length and included characters")
        times, most = self.integer(start, stop) - len(include), stop - len(include)
        plain = all(len(ch) == 1 and ch.isascii() for ch in pool)
        if plain and 0 < most <= _UNROLLED and all(len(ch) == 1 for ch in include):
            characters = self._characters(pool, times, most)
            return self._inserted(characters, times, include) if include else characters
        characters = self.repeated(times, lambda draws: draws.choice(pool))
        if include:
            characters = self.shuffle(F.concat(characters, F.array(*map(F.lit, include))))
        return F.array_join(characters, "")

    def _characters(self, pool: Sequence[str], times: Column, most: int) -> Column:
        """`times` ASCII characters of a pool, at most `most`, as one string and without a lambda per place.

        The row is hashed once, and every place from that hash. The characters' codes become the bytes
        of whole numbers, because joining strings of one character costs more than drawing them.
        """
        number = self.count
        row, size = self._hash(), F.lit(len(pool))
        codes = F.split(F.lit(",".join(str(ord(ch)) for ch in pool)), ",").cast("array<bigint>")
        blocks = []
        for first in range(0, most, _BLOCK):
            last = min(first + _BLOCK, most)
            drawn = [F.get(codes, F.pmod(F.xxhash64(row.bitwiseXOR(place)), size).cast("int"))
                     for place in range(first, last)]
            digits = F.hex(reduce(lambda left, code: F.shiftleft(left, 8).bitwiseOR(code), drawn))
            if any(ord(ch) < 16 for ch in pool):
                digits = F.lpad(digits, 2 * (last - first), "0")
            blocks.append(F.when(times > first, digits).otherwise("") if first else digits)
        characters = F.substring(F.unhex(F.concat(*blocks)), F.lit(1), times).cast("string")
        # No text is longer, so this lambda never runs. An operator that has one is compiled as many
        # small methods; whole-stage code would be one, too long for the JVM to compile.
        self.count = number
        rest = F.array_join(self.repeated(times, lambda draws: draws.choice(pool)), "")
        return F.concat(characters, F.when(times > most, rest).otherwise(""))

    def _inserted(self, characters: Column, length: Column, items: Sequence[str]) -> Column:
        """A string of `length` characters drawn alike, with further ones put at random places.

        Each goes to any place with equal weights, so all orders are as likely as after a shuffle.
        """
        before = self.count
        for place, item in enumerate(items, 1):
            self.count = before
            position = F.pmod(self.at(F.lit(place))._hash(), length + place) + 1
            characters = F.overlay(characters, F.lit(item), position.cast("int"), F.lit(0))
        return characters

    def repeated(self, times: Column, draw: Callable[[Draws], Column]) -> Column:
        """An array of text drawn anew for each of `times` places; one expression of any length."""
        places = F.sequence(F.lit(1), F.greatest(times, F.lit(1)))
        return F.slice(F.transform(places, lambda place: draw(self.at(place))), F.lit(1), times)
