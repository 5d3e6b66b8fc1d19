"""Licence scans: units of text against licence templates by Dice coefficient.

A text's units are its lines, its paragraphs of several lines and the whole;
besides, notices inside or across these are found in windows of its words.
Units and templates are normalised alike - runs of ASCII letters and digits,
lower case - and compared by the Dice coefficient of their sets of word
bigrams. Dice >= t needs ``t / (2 - t) <= |A| / |B| <= (2 - t) / t``, so most
templates are passed over by size alone; texts that lack every word a match
must share are passed over first. Only DataFrame functions are used.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table, text_or_empty

DICE = Fraction(4, 5)

# Notices as their licences ask for them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
}


def bigrams(text: str) -> list[str]:
    """Set of word bigrams of a normalised text, sorted."""
    words = re.sub("[^A-Za-z0-9]+", " ", text).strip().lower().split(" ")
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def anchors(known: dict[str, list[str]], dice: Fraction) -> list[str]:
    """Words of which every unit that reaches ``dice`` with some template holds
    one: of a template's n bigrams such a unit shares at least m, so words that
    leave fewer than m bigrams untouched cannot all be missing. Long words,
    then those that touch most bigrams, are taken first."""
    t = dice
    open_ = {}
    for name, grams in known.items():
        least = math.ceil(len(grams) * t / (2 - t))
        open_[name] = (set(grams), math.ceil(t / 2 * (len(grams) + least)))
    out: list[str] = []
    while True:
        left = [g for g, m in open_.values() if len(g) >= m]
        if not left:
            return sorted(out)
        gain = Counter(w for g in left for b in g for w in set(b.split(" ")))
        word = max(gain, key=lambda w: (len(w) >= 5, gain[w], len(w), w))
        out.append(word)
        for g, _ in open_.values():
            g.difference_update([b for b in g if word in b.split(" ")])


def unit_bigrams(unit: Column) -> Column:
    """The same for a unit of a text normalised but for its line ends."""
    w = F.split(F.trim(F.translate(unit, "\n", " ")), " +")
    return F.array_distinct(F.zip_with(F.slice(w, F.lit(1), F.size(w) - 1), F.slice(w, F.lit(2), F.size(w) - 1),
                                       lambda a, b: F.concat(a, F.lit(" "), b)))


def anchored_by(known: dict[str, list[str]], dice: Fraction) -> str:
    return f"(?i)(?<![a-z0-9])(?:{'|'.join(anchors(known, dice))})(?![a-z0-9])"


def template_literal(known: dict[str, list[str]]) -> Column:
    """Templates as one literal: their number and size are those of this module."""
    return F.array(*[F.struct(F.lit(name).alias("license"), F.lit(-i).alias("order"),
                              F.lit(len(grams)).alias("n"), F.array(*map(F.lit, grams)).alias("grams"))
                     for i, (name, grams) in enumerate(known.items())])


def matcher(literal: Column, dice: Fraction):
    """Function of a unit's bigrams: their number and the best template."""
    num, den = dice.numerator, dice.denominator

    def matched(b: Column) -> Column:
        n = F.size(b)
        fitting = F.filter(literal, lambda t: (n * (2 * den - num) >= t["n"] * num)
                           & (n * num <= t["n"] * (2 * den - num)))
        shared = F.transform(fitting, lambda t: F.struct(
            F.size(F.array_intersect(b, t["grams"])).alias("shared"), (n + t["n"]).alias("both"),
            t["order"].alias("order"), t["license"].alias("license")))
        hits = F.filter(shared, lambda x: 2 * x["shared"] * den >= num * x["both"])
        best = F.array_max(F.transform(hits, lambda x: F.struct(
            (2.0 * x["shared"] / x["both"]).alias("dice"), x["order"].alias("order"),
            x["license"].alias("license"))))
        return F.struct(n.alias("n"), best.alias("best"))
    return matched


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, str] = TEMPLATES, dice: Fraction = DICE) -> DataFrame:
    """The best template of each unit that reaches ``dice`` with any: (id,
    ``unit``, ``position``, ``license``, ``n_bigrams``, ``dice``). Ties go to
    the first name.

    Null and empty texts, and units of fewer than two words, match nothing.
    Repeated lines and rows are reported each. A paragraph or document of one
    line is reported as that line only. An empty table gives an empty result.
    Other columns are not read.
    """
    num, den = dice.numerator, dice.denominator
    known = {k: b for k, v in sorted(templates.items()) if (b := bigrams(v))}
    # texts and units that no template can match go before any bigram is made
    anchored = anchored_by(known, dice)
    docs = docs.filter(F.col(f"`{text_col}`").rlike(anchored))
    text = F.lower(F.regexp_replace(text_or_empty(F.col(f"`{text_col}`")), "[^A-Za-z0-9\n]+", " "))
    lines = F.transform(F.split("_text", "\n"), lambda x, i: F.struct(
        F.lit("line").alias("unit"), i.alias("position"), x.alias("body")))
    paras = F.filter(F.transform(F.split("_text", "\n *\n"), lambda x, i: F.struct(
        F.lit("paragraph").alias("unit"), i.alias("position"), x.alias("body"))),
        lambda p: p["body"].contains("\n"))
    whole = F.array(F.struct(F.lit("document").alias("unit"), F.lit(0).alias("position"),
                             F.col("_text").alias("body")))
    none = F.filter(whole, lambda _: F.lit(False))
    several = F.col("_text").rlike("\n *\n")
    units = (docs.select(F.col(f"`{id_col}`").alias(id_col), text.alias("_text"))
             .select(id_col, F.explode(F.concat(
                 lines, F.when(several, paras).otherwise(none),
                 F.when(F.col("_text").contains("\n"), whole).otherwise(none))).alias("_u")))
    # a unit with fewer bigrams than any bound has too few characters as well
    least = -(-min(map(len, known.values())) * num // (2 * den - num))
    # the lambda variable holds a unit's bigrams: they are computed once
    match = F.explode(F.transform(F.array(unit_bigrams(F.col("_u.body"))),
                                  matcher(template_literal(known), dice)))
    return (units.filter((F.length("_u.body") >= 2 * least + 1) & F.col("_u.body").rlike(anchored))
            .select(id_col, "_u.unit", "_u.position", match.alias("_m")).filter("_m.best is not null")
            .select(id_col, "unit", F.col("position").cast("int").alias("position"), "_m.best.license",
                    F.col("_m.n").alias("n_bigrams"), "_m.best.dice"))


def pairs_of(words: Column) -> Column:
    """Word bigrams, in order, of an array of structs with a word ``w``."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n),
                      lambda a, b: F.concat(a["w"], F.lit(" "), b["w"]))


def embedded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             templates: dict[str, str] = TEMPLATES, dice: Fraction = DICE) -> DataFrame:
    """Notices that are no unit of their own: in a sentence or a running
    paragraph, or over several lines or paragraphs of a longer text. Columns
    as of ``scan``; ``unit`` is "window" and ``position`` its first word.

    Windows of consecutive words begin and end with a bigram of the template:
    others only add to the size. They have at most as many bigrams, repeats
    counted, as the bound on sizes allows. Of windows that overlap, that of the
    largest template by its Dice coefficient stays. Windows inside a line, a
    paragraph or a document that matches as a whole are left to ``scan``.

    Bigrams that no template has are passed over by one look-up each; windows
    are sought in stretches where a template's bigrams stand close enough, a
    single pass to the right from each. The work grows with the text.

    Null and empty texts match nothing; repeated notices and rows are reported
    each; an empty table gives an empty result; other columns are not read.
    """
    num, den = dice.numerator, dice.denominator
    known = {k: b for k, v in sorted(templates.items()) if (b := bigrams(v))}
    raw = {k: len(re.sub("[^A-Za-z0-9]+", " ", templates[k]).split()) - 1 for k in known}
    literal = F.array(*[F.struct(
        F.lit(k).alias("license"), F.lit(-i).alias("order"), F.lit(len(g)).alias("n"),
        F.lit(-(-len(g) * num // (2 * den - num))).alias("least"),
        F.lit(raw[k] * (2 * den - num) // num).alias("most"), F.array(*map(F.lit, g)).alias("grams"))
        for i, (k, g) in enumerate(known.items())])
    every = sorted({b for g in known.values() for b in g})
    fewest = min(-(-len(g) * num // (2 * den - num)) for g in known.values())
    text = F.lower(F.regexp_replace(text_or_empty(F.col(f"`{text_col}`")), "[^A-Za-z0-9\n]+", " "))
    words = F.flatten(F.transform(F.split(text, "\n *\n"), lambda x, p: F.flatten(F.transform(
        F.split(x, "\n"), lambda y, q: F.transform(F.filter(F.split(y, " +"), lambda z: z != ""), lambda z: F.struct(
            z.alias("w"), p.alias("paragraph"), q.alias("line")))))))

    def once(c: Column) -> Column:
        """Computed a single time, whatever reads it: no filter passes a generator."""
        return F.explode(F.array(c))

    hits = F.filter(F.transform("_b", lambda b, i: F.struct(b.alias("b"), i.alias("i"))), lambda x: x["b"].isin(every))
    rows = (docs.filter(F.col(f"`{text_col}`").rlike(anchored_by(known, dice)))
            .select(F.col(f"`{id_col}`").alias(id_col), once(words).alias("_w"))
            .select(id_col, "_w", once(pairs_of(F.col("_w"))).alias("_b"))
            .select(id_col, "_w", "_b", once(hits).alias("_h")).filter(F.size("_h") >= fewest))

    def bound(c: Column, f) -> Column:
        """``f`` of a value computed once."""
        return F.flatten(F.transform(F.array(c), f))

    def stretches(t: Column, at: Column) -> Column:
        """(first, last) of runs of at least ``least`` of the positions ``at``
        that are less than a window's length apart from one to the next."""
        def step(a: Column, i: Column) -> Column:
            near = (a["n"] > 0) & (i - a["last"] < t["most"])
            return F.struct(
                F.when(near | (a["n"] < t["least"]), a["done"])
                .otherwise(F.concat(a["done"], F.array(F.struct(a["first"].alias("first"), a["last"].alias("last"))))).alias("done"),
                F.when(near, a["first"]).otherwise(i).alias("first"), i.alias("last"),
                F.when(near, a["n"] + 1).otherwise(F.lit(1)).alias("n"))
        none = F.expr("cast(array() as array<struct<first: int, last: int>>)")
        start = F.struct(none.alias("done"), F.lit(0).alias("first"), F.lit(0).alias("last"), F.lit(0).alias("n"))
        # a position out of reach closes the last run
        return F.aggregate(F.concat(at, F.array(F.lit(2 ** 31 - 1))), start, step, lambda a: a["done"])

    def marked(t: Column, r: Column) -> Column:
        """For each bigram of a stretch: whether the template has it, and how
        far back it stood before (0: not within a window's length)."""
        part = F.slice("_b", r["first"] + 1, r["last"] - r["first"] + 1)
        return bound(part, lambda g: F.transform(g, lambda b, i: F.struct(
            F.array_contains(t["grams"], b).alias("hit"),
            F.array_position(F.reverse(F.slice(g, F.greatest(i - t["most"], F.lit(0)) + 1, F.least(i, t["most"]))), b)
            .cast("int").alias("back"))))

    def windows(t: Column, first: Column, x: Column) -> Column:
        """Windows from each hit of a stretch: going right, a bigram that did
        not stand in the window before adds to its size, and to what it shares."""
        kind = "array<struct<s: int, e: int, n: int, shared: int>>"

        def step(a: Column, y: Column, s: Column) -> Column:
            fresh = (y["back"] == 0) | (a["p"] - y["back"] < s)
            n = a["n"] + fresh.cast("int")
            shared = a["shared"] + (fresh & y["hit"]).cast("int")
            d = 2.0 * shared / (n + t["n"])
            # one around a better one of the same start is never the best of those it overlaps
            good = y["hit"] & (2 * shared * den >= num * (n + t["n"])) & (d >= a["best"])
            return F.struct((a["p"] + 1).alias("p"), n.alias("n"), shared.alias("shared"),
                            F.when(good, d).otherwise(a["best"]).alias("best"),
                            F.when(good, F.concat(a["out"], F.array(F.struct(
                                (first + s).alias("s"), (first + a["p"]).alias("e"), n.alias("n"), shared.alias("shared")))))
                            .otherwise(a["out"]).alias("out"))

        def of(v: Column, s: Column) -> Column:
            start = F.struct(s.alias("p"), F.lit(0).alias("n"), F.lit(0).alias("shared"), F.lit(0.0).alias("best"),
                             F.expr(f"cast(array() as {kind})").alias("out"))
            return F.when(v["hit"], F.aggregate(F.slice(x, s + 1, t["most"]), start, lambda a, y: step(a, y, s),
                                                lambda a: a["out"])).otherwise(F.expr(f"cast(array() as {kind})"))
        return F.transform(F.flatten(F.transform(x, of)), lambda c: F.struct(
            (2.0 * c["shared"] / (c["n"] + t["n"]) * t["n"]).alias("weight"), t["order"].alias("order"),
            (-c["s"]).alias("first"), c["s"].alias("s"), c["e"].alias("e"), t["license"].alias("license"), c["n"].alias("n"),
            (2.0 * c["shared"] / (c["n"] + t["n"])).alias("dice")))

    def of_template(t: Column) -> Column:
        at = F.transform(F.filter("_h", lambda x: F.array_contains(t["grams"], x["b"])), lambda x: x["i"])
        return F.flatten(F.transform(stretches(t, at), lambda r: bound(marked(t, r), lambda x: windows(t, r["first"], x))))

    found = F.flatten(F.transform(literal, of_template))
    rows = rows.select(id_col, "_w", once(found).alias("_f")).filter(F.size("_f") > 0)
    # windows that share a word overlap; the first taken is the best
    best = F.aggregate(F.reverse(F.array_sort("_f")), F.filter("_f", lambda _: F.lit(False)), lambda got, x: F.when(
        F.exists(got, lambda y: (x["s"] <= y["e"] + 1) & (y["s"] <= x["e"] + 1)), got)
        .otherwise(F.concat(got, F.array(x))))
    rows = rows.select(id_col, "_w", F.explode(best).alias("_x"))
    matched = matcher(template_literal(known), dice)
    a, z = F.get("_w", F.col("_x.s")), F.get("_w", F.col("_x.e") + 1)

    def covers(*same: str) -> Column:
        inside = F.lit(True)
        for c in same:
            inside = inside & (a[c] == z[c])
        unit = F.filter("_w", lambda x: F.forall(F.array(*[x[c] == a[c] for c in same]) if same else F.array(F.lit(True)),
                                                 lambda y: y))
        whole = F.transform(F.array(F.array_distinct(pairs_of(unit))), matched)
        return F.when(inside, F.get(whole, F.lit(0))["best"].isNotNull()).otherwise(False)

    return (rows.filter(~covers("paragraph", "line")).filter(~covers("paragraph")).filter(~covers())
            .select(id_col, F.lit("window").alias("unit"), F.col("_x.s").cast("int").alias("position"), "_x.license",
                    F.col("_x.n").alias("n_bigrams"), "_x.dice"))


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs).unionByName(embedded(docs))


def oracle(templates: dict[str, str] = TEMPLATES, dice: Fraction = DICE) -> str:
    """The same scan of ``documents`` in DuckDB SQL."""
    quoted = ", ".join("('{}', '{}')".format(k.replace("'", "''"), v.replace("'", "''"))
                       for k, v in sorted(templates.items()))
    num, den = dice.numerator, dice.denominator
    return f"""
WITH tpl(license, body) AS (VALUES {quoted}),
tw AS (SELECT license, string_split(lower(trim(regexp_replace(body, '[^A-Za-z0-9]+', ' ', 'g'))), ' ') AS w FROM tpl),
tb AS (SELECT license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM tw),
d AS (SELECT doc_id, lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9\\n]+', ' ', 'g')) AS t FROM documents),
u AS (SELECT doc_id, 'line' AS unit, unnest(range(len(string_split(t, chr(10)))))::INT AS position,
             unnest(string_split(t, chr(10))) AS body FROM d
      UNION ALL SELECT * FROM (SELECT doc_id, 'paragraph' AS unit,
             unnest(range(len(regexp_split_to_array(t, '\\n *\\n'))))::INT AS position,
             unnest(regexp_split_to_array(t, '\\n *\\n')) AS body FROM d WHERE regexp_matches(t, '\\n *\\n'))
             WHERE contains(body, chr(10))
      UNION ALL SELECT doc_id, 'document', 0, t FROM d WHERE contains(t, chr(10))),
w AS (SELECT doc_id, unit, position,
             regexp_split_to_array(trim(replace(body, chr(10), ' ')), ' +') AS w FROM u),
b AS (SELECT doc_id, unit, position,
             list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
      FROM w WHERE len(w) > 1),
s AS (SELECT doc_id, unit, position, license, len(b.g)::INT AS n_bigrams, len(tb.g) AS tn,
             len(list_intersect(b.g, tb.g)) AS shared
      FROM b JOIN tb ON len(b.g) * {2 * den - num} >= len(tb.g) * {num} AND len(b.g) * {num} <= len(tb.g) * {2 * den - num}),
r AS (SELECT *, 2.0::DOUBLE * shared / (n_bigrams + tn) AS dice FROM s WHERE 2 * shared * {den} >= {num} * (n_bigrams + tn))
SELECT doc_id, unit, position, license, n_bigrams, dice FROM r
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, position ORDER BY dice DESC, license) = 1
"""
