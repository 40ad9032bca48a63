r"""Text templates: a value generator and the matching regular expression in one object.

A template is composed in Python, for example `group("w", either(text("foo"), text("bar"))) +
text("baz") + back("w")`. `column` draws a value per row, `pattern` is the regular expression
every drawn value matches.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from ratesmith.functions.synth import ALPHABETS, Draws

PRINTABLE = ALPHABETS["printable"]
UNBOUNDED_MAX = 100  # longest repetition drawn by default where the template gives no upper limit


@dataclass(frozen=True)
class Template:
    """`build(draws, groups)` makes the column; `groups` holds the columns of named groups."""

    pattern: str
    build: Callable[[Draws, dict], Column]

    def column(self, draws: Draws) -> Column:
        return self.build(draws, {})

    def __add__(self, other: Template) -> Template:
        return Template(
            self.pattern + other.pattern,
            lambda draws, groups: F.concat(self.build(draws, groups), other.build(draws, groups)),
        )


def text(literal: str) -> Template:
    return Template(re.escape(literal), lambda draws, groups: F.lit(literal))


def any_of(characters: str) -> Template:
    """One of the characters."""
    body = "".join(re.escape(ch) for ch in characters)
    return Template(f"[{body}]", lambda draws, groups: draws.choice(list(characters)))


def span(first: str, last: str) -> Template:
    """One character from first to last."""
    return any_of("".join(map(chr, range(ord(first), ord(last) + 1))))


def none_of(characters: str) -> Template:
    """One printable character other than these."""
    pool = [ch for ch in PRINTABLE if ch not in characters]
    body = "".join(re.escape(ch) for ch in characters)
    return Template(f"[^{body}]", lambda draws, groups: draws.choice(pool))


def any_character() -> Template:
    """One printable character other than the line ends a dot does not match."""
    pool = [ch for ch in PRINTABLE if ch not in "\n\r"]
    return Template(".", lambda draws, groups: draws.choice(pool))


def digit() -> Template:
    return Template(r"\d", any_of(ALPHABETS["digits"]).build)


def non_digit() -> Template:
    return Template(r"\D", none_of(ALPHABETS["digits"]).build)


def word() -> Template:
    return Template(r"\w", any_of(ALPHABETS["word"]).build)


def non_word() -> Template:
    return Template(r"\W", any_of(ALPHABETS["nonword"]).build)


def either(*options: Template) -> Template:
    """One of the templates."""

    def build(draws: Draws, groups: dict) -> Column:
        drawn = F.array(*[option.build(draws, groups) for option in options])
        return F.element_at(drawn, draws.integer(1, len(options)))

    return Template("(?:" + "|".join(option.pattern for option in options) + ")", build)


def repeat(
    part: Template, least: int, most: int | None = None, lazy: bool = False, longest: int = UNBOUNDED_MAX
) -> Template:
    """The template drawn anew `least` to `most` times; without `most`, up to `longest` times.

    Outside, `back` to a group of the repeated part gives the value of its last round.
    """
    limit = max(least, longest) if most is None else most
    if not 0 <= least <= limit:
        raise ValueError("repetition limits must satisfy 0 <= least <= most")

    def build(draws: Draws, groups: dict) -> Column:
        times = draws.integer(least, limit)
        before, inner = draws.count, dict(groups)
        value = F.array_join(draws.repeated(times, lambda place: part.build(place, inner)), "")
        if any(inner[name] is not groups.get(name) for name in inner):
            after, draws.count = draws.count, before
            part.build(draws.at(times), groups)
            draws.count = after
        return value

    upper = "" if most is None else str(most)
    return Template(f"(?:{part.pattern}){{{least},{upper}}}{'?' if lazy else ''}", build)


def group(name: str, part: Template) -> Template:
    """A template whose drawn value can be repeated with `back`."""

    def build(draws: Draws, groups: dict) -> Column:
        groups[name] = part.build(draws, groups)
        return groups[name]

    return Template(f"(?<{name}>{part.pattern})", build)


def back(name: str) -> Template:
    """The value drawn for a group before."""
    return Template(rf"\k<{name}>", lambda draws, groups: groups[name])


def followed_by(part: Template) -> Template:
    """Look-ahead; the text looked at is drawn too, so that the value matches on its own."""
    return Template(f"(?={part.pattern})", part.build)


def preceded_by(part: Template) -> Template:
    """Look-behind; the text looked at is drawn too."""
    return Template(f"(?<={part.pattern})", part.build)


def not_followed_by(part: Template) -> Template:
    """Negative look-ahead; draws nothing."""
    return Template(f"(?!{part.pattern})", lambda draws, groups: F.lit(""))


def at_start() -> Template:
    return Template("^", lambda draws, groups: F.lit(""))


def at_end() -> Template:
    return Template("$", lambda draws, groups: F.lit(""))
