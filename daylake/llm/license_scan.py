r"""License scans: windows of normalised text against licence templates by Dice coefficient over word bigrams.

Text is normalised to lower-case words of letters and digits.  A window is a run of words; its
Dice coefficient with a template is twice the number of shared bigrams (with repeats) over the number of
bigrams of both.  Dice >= t bounds a window's bigrams by t / (2 - t) and (2 - t) / t times the template's,
so windows and templates out of these bounds are never compared; and the best window starts and ends with a bigram
of the template, so only words of texts that hold such bigrams are looked at.

For each text and template the window with the highest coefficient is told (ties: the
earliest, then the shortest); a text's licence is the best of these (ties: the first template).
A licence may have several templates: its notice, short forms, its whole text.  A window inside another one ``PART`` times as long is
part of that text (the notice that a licence's text quotes) and ranks after those that are not; a mere reservation
of rights ranks after every licence.

Defined cases
  null text       as the empty text: no licence
  one word        has no bigram: no licence
  very long text  scanned whole
  repeated rows   scanned each
  empty table     no rows
  extra columns   kept; a column with the name of an output column is replaced
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection, Iterator, Mapping
from importlib.resources import files

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Notices as the licences ask for them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
    " that the following conditions are met",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
PROPRIETARY = "proprietary"
CC_KINDS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic"}
# Licences whose whole text is a template, too: licenses/<name>.txt, without the holder's own lines.
WHOLE_TEXTS = ("Apache-2.0", "MIT", "GPL-3.0", "GPL-2.0", "BSD-3-Clause", "BSD-2-Clause", "MPL-2.0", "CC0-1.0")
# A window inside another one so many times as long is part of it.
PART = 4
MIN_DICE = 0.8
WORD = re.compile(r"[^\W_]+")
# Templates travel with the tasks.
MAX_TEMPLATE_CHARS = 8 << 20


def production() -> dict[str, tuple[str, ...]]:
    """Licence -> its templates: the notices, the Creative Commons family in long and short forms, a reservation of rights, whole texts."""
    made = {name: (text,) for name, text in TEMPLATES.items()}

    def add(name: str, *texts: str) -> None:
        made[name] = (*made.get(name, ()), *(t for t in texts if t not in made.get(name, ())))

    for version, port in CC_VERSIONS.items():
        for kind, title in CC_KINDS.items():
            add(
                f"CC-{kind}-{version}",
                f"This work is licensed under a Creative Commons {title} {version} {port} License.",
                f"Creative Commons {title} {version} {port} License",
                f"Licensed under CC {kind} {version}.",
                f"CC {kind} {version} License",
            )
    add(
        "CC0-1.0",
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or"
        " neighboring rights to this work.",
        "Creative Commons CC0 1.0 Universal",
        "Licensed under CC0 1.0.",
        "CC0 1.0 Universal License",
        "CC0 1.0 License",
        "CC0 1.0 Universal Public Domain Dedication",
    )
    add(PROPRIETARY, "All rights reserved.")
    for name in WHOLE_TEXTS:
        add(name, files("daylake.llm").joinpath("licenses", f"{name}.txt").read_text(encoding="utf-8"))
    return made


def normalised(text: str) -> list[str]:
    return WORD.findall(text.lower())

# Starts of windows that are judged together.
STRIDE = 64


def bigrams(words: list[str]) -> list[tuple[str, str]]:
    return list(zip(words, words[1:]))


def dice(a: Counter, b: Counter) -> float:
    n = a.total() + b.total()
    return 2 * (a & b).total() / n if n else 0.0


class Template:
    def __init__(self, name: str, text: str, least: float):
        self.name, self.grams = name, Counter(bigrams(normalised(text)))
        self.size = self.grams.total()
        # Size bounds of a window, rounded outwards: the coefficient decides.
        self.low = int(self.size * least / (2 - least))
        self.high = int(self.size * (2 - least) / least) + 1

    def best(self, hits: list[int], grams: dict[int, tuple[str, str]], least: float) -> tuple[float, int, int] | None:
        """The best window as (coefficient, first bigram, last bigram).  ``hits``: where the template's bigrams are."""
        if len(hits) < self.low * least / 2:
            return None
        at = np.array(hits)
        last = np.searchsorted(at, at + (self.high - 1), "right")
        # Each hit shares one bigram at most.
        starts = np.flatnonzero(2 * (last - np.arange(len(at))) >= least * (self.size + 1))
        if not len(starts):
            return None
        # A hit is shared if the window has fewer earlier ones of its bigram than the template has: if it starts after this one.
        back = np.full(len(at), -1)
        met: dict[tuple[str, str], list[int]] = {}
        for i, place in enumerate(hits):
            earlier = met.setdefault(grams[place], [])
            if len(earlier) >= (n := self.grams[grams[place]]):
                back[i] = earlier[-n]
            earlier.append(i)
        best = None
        starts = starts.tolist()
        p = 0
        while p < len(starts):
            k = starts[p]
            # From the window's shared bigrams at one start follows what the next ``STRIDE`` starts can reach at most: no more
            # shared ones, in windows shorter by the words between. Where that is not above the best, they are passed over.
            q = min(p + STRIDE, len(starts) - 1) if p % STRIDE == 0 else p
            until = int(last[starts[q]])
            sizes = at[k:until] - at[k] + 1
            shared = np.cumsum(back[k:until] < k)
            own = int(last[k]) - k
            scores = 2 * shared[:own] / (sizes[:own] + self.size)
            scores[sizes[:own] < self.low] = 0
            end = int(scores.argmax())
            if scores[end] >= least and (best is None or scores[end] > best[0]):
                best = float(scores[end]), hits[k], hits[k + end]
            p += 1
            if best and q >= p:
                reach = 2 * shared / (np.maximum(sizes - (at[starts[q]] - at[k]), shared) + self.size)
                if reach.max() <= best[0]:
                    p = q + 1
        return best


def find(text: str, templates: list[Template], known: dict[tuple[str, str], list[int]], least: float, after: Collection[str] = ()) -> list[tuple[str, float, int, int]]:
    """(licence, coefficient, first word, word after the last) of every template with a window, best first."""
    words = normalised(text)
    grams = {i: g for i, g in enumerate(zip(words, words[1:])) if g in known}
    if not grams:
        return []
    hits: dict[int, list[int]] = {}
    for i, g in grams.items():
        for t in known[g]:
            hits.setdefault(t, []).append(i)
    found = []
    for t in sorted(hits):
        if one := templates[t].best(hits[t], grams, least):
            found.append((-one[0], t, one[1], one[2] + 2))

    def rank(one: tuple[float, int, int, int]) -> tuple:
        score, t, a, b = one
        part = any(x <= a and b <= y and y - x >= PART * (b - a) for _, _, x, y in found)
        return templates[t].name in after, part, score, t

    return [(templates[t].name, -score, a, b) for score, t, a, b in sorted(found, key=rank)]


def scan(
    docs: DataFrame,
    text_col: str = "text",
    templates: Mapping[str, str | tuple[str, ...]] = TEMPLATES,
    min_dice: float = MIN_DICE,
    after: Collection[str] = (PROPRIETARY,),
) -> DataFrame:
    """The columns of ``docs`` with ``license`` (null: none), ``dice`` (to 6 places) and ``licenses``: every template
    that has a window, best first, with its coefficient and word span (end exclusive).  ``templates``: a licence's template or
    templates (:func:`production` has them all, ``TEMPLATES`` the notices alone); the licences ``after`` rank last."""
    wordings = [(n, t) for n, given in templates.items() for t in ((given,) if isinstance(given, str) else given)]
    if sum(len(t) for _, t in wordings) > MAX_TEMPLATE_CHARS:
        raise ValueError(f"templates have over {MAX_TEMPLATE_CHARS} characters")
    if not 0 < min_dice <= 1:
        raise ValueError("min_dice lies above 0, at most 1")
    made = [Template(n, t, min_dice) for n, t in wordings]
    known: dict[tuple[str, str], list[int]] = {}
    for i, t in enumerate(made):
        for g in t.grams:
            known.setdefault(g, []).append(i)
    one = T.StructType(
        [T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
    added = [T.StructField("license", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("licenses", T.ArrayType(one))]
    kept = [f for f in docs.schema.fields if f.name not in {a.name for a in added}]
    arrow = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"license": n, "dice": round(s, 6), "start": a, "end": b} for n, s, a, b in find(t, made, known, min_dice, after)] if t else []
                for t in (x.as_py() for x in batch.column(text_col))
            ]
            arrays = [batch.column(f.name) for f in kept]
            arrays += [pa.array([f[0]["license"] if f else None for f in found], pa.string()), pa.array([f[0]["dice"] if f else None for f in found], pa.float64()), pa.array(found, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in kept + added])

    return docs.mapInArrow(run, T.StructType(kept + added))
