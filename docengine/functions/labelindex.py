"""A compiled index of label variants: one pass over the words finds the labels of all fields.

Every token of every variant has a bit, tokens of a variant standing next to each other, variants of a
field in their order.  A word's mask has the bits of the tokens it fits (either contains the other), and is
computed once per word, where words are still rows.  A variant ends at a word if its last token's bit is
set there, the bit before in the word before, and so on: shifted masks are anded, for all variants at
once.  The lowest bit of a field in a line is its first variant, so no field looks at a word again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from docengine.functions import text as T

BITS = 62


def tokens(variant: str) -> tuple[str, ...]:
    """Normalised tokens of a label variant, on the driver."""
    return tuple(t for t in (T.normalize_py(p) for p in re.split(r"\s+|[:\-–—|=]+", variant.strip())) if t)


@dataclass(frozen=True)
class LabelIndex:
    """Bits of tokens, and for each field and length of a variant the bits of their last tokens."""

    bits: tuple[tuple[str, int], ...]
    ends: tuple[tuple[str, int], ...]
    lengths: tuple[tuple[int, int], ...]

    @staticmethod
    def of(wanted: dict[str, list[str]]) -> LabelIndex:
        """The index of field -> variants; more tokens than bits need another index."""
        bits: dict[str, int] = {}
        ends: dict[str, int] = {}
        lengths: dict[int, int] = {}
        at = 0
        for field, variants in wanted.items():
            for variant in dict.fromkeys(v for v in map(tokens, variants) if v):
                for t in variant:
                    bits[t] = bits.get(t, 0) | 1 << at
                    at += 1
                ends[field] = ends.get(field, 0) | 1 << at - 1
                lengths[len(variant)] = lengths.get(len(variant), 0) | 1 << at - 1
        if at > BITS:
            raise ValueError(f"{at} tokens do not fit into {BITS} bits")
        return LabelIndex(tuple(bits.items()), tuple(ends.items()), tuple(sorted(lengths.items())))

    @property
    def fields(self) -> list[str]:
        return [f for f, _ in self.ends]

    def mask(self, norm: Column) -> Column:
        """Bits of the tokens that a word's normal form fits; an empty one fits none."""
        out = F.lit(0).cast("long")
        for t, b in self.bits:
            out = out.bitwiseOR(F.when(F.contains(norm, F.lit(t)) | F.contains(F.lit(t), norm), F.lit(b).cast("long")).otherwise(F.lit(0).cast("long")))
        return F.when(norm != "", out).otherwise(F.lit(0).cast("long"))

    def ended(self, masks: Column) -> Column:
        """For each word of a line, given the words' masks, the variants that end there."""
        longest = self.lengths[-1][0] if self.lengths else 0

        def at(m: Column, i: Column) -> Column:
            out, chain = F.lit(0).cast("long"), m
            by_length = dict(self.lengths)
            for n in range(1, longest + 1):
                if n > 1:
                    before = F.when(i >= n - 1, F.get(masks, i - (n - 1))).otherwise(F.lit(0).cast("long"))
                    chain = chain.bitwiseAND(F.shiftleft(before, n - 1))
                if n in by_length:
                    out = out.bitwiseOR(chain.bitwiseAND(F.lit(by_length[n]).cast("long")))
            return out

        return F.transform(masks, at)

    def span(self, field: str, lines: Column, ends: Column, any_end: Column) -> Column:
        """struct<at, first, last> of the first label of a field by line, then variant, then position; null if none.

        ``lines`` are arrays of words, ``ends`` what ``ended`` gives for each, ``any_end`` the
        union of it by line.
        """
        own = dict(self.ends).get(field, 0)
        hit = F.array_position(F.transform(any_end, lambda a: a.bitwiseAND(F.lit(own).cast("long")) != 0), F.lit(True)).cast("int")
        line = F.get(ends, hit - 1)
        here = F.get(any_end, hit - 1).bitwiseAND(F.lit(own).cast("long"))
        low = here.bitwiseAND(F.negate(here))
        last = F.array_position(F.transform(line, lambda e: e.bitwiseAND(low) != 0), F.lit(True)).cast("int") - 1
        size = F.lit(1)
        for n, b in self.lengths[::-1]:
            size = F.when(low.bitwiseAND(F.lit(b).cast("long")) != 0, n).otherwise(size)
        words = F.get(lines, hit - 1)
        return F.when(hit > 0, F.struct((hit - 1).alias("at"), F.get(words, last - size + 1).alias("first"), F.get(words, last).alias("last")))
