"""License scans by diagonal voting.

Every document's rolling hashes of neighbouring word pairs are joined to the places of
the same pairs in license templates.  A hit votes for its *diagonal*, the document
place minus the template place: text that follows the template stays on one diagonal,
and a word put in or left out moves it to a neighbour.  Votes are counted by diagonal,
neighbouring diagonals are merged into spans, and a span counts if enough of the
template's pairs lie in it and its length fits; in a longer span the parts of fitting
length are looked at instead.  The join also compares the words, so
a hash that two pairs share gives no hit.

Phrases are templates that must be whole, on one diagonal.  Everything is done with
DataFrame functions.  The templates are a parameter of bounded size; only hits are
shuffled, by document, and nothing is grouped over documents.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A to Z are put in lower case.
A null text is empty.  Rows that repeat id and text give the same result each.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import ascii_lower

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Diagonals up to so far apart belong to one span.
DRIFT = 3
MAX_TEMPLATE_WORDS = 100_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Share of the word pairs that must be there; 1 for a phrase that must be whole.
    cover: float = 1.0

    @property
    def is_phrase(self) -> bool:
        return self.cover >= 1

    @property
    def words(self) -> list[str]:
        return [w for w in "".join(c if c.isalnum() else " " for c in self.text).lower().split()]


PHRASES = (
    Template("gpl", "gnu general public license"),
    Template("apache", "apache license"),
    Template("cc-by", "cc by"),
    Template("mit", "mit license"),
)

#: Wordings of well-known license notices.
NOTICES = (
    Template(
        "gpl-notice",
        "This work is licensed under the GNU General Public License, version 3.",
        0.6,
    ),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation",
        0.5,
    ),
    Template("apache-notice", "Licensed under the Apache License, Version 2.0.", 0.7),
    Template("mit-notice", "Released under the MIT License.", 0.7),
    Template(
        "mit-notice",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files",
        0.5,
    ),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0.", 0.7),
    Template("cc-by-sa", "Licensed under CC BY-SA 4.0.", 0.9),
    Template(
        "cc-by-notice",
        "This work is licensed under a Creative Commons Attribution International License",
        0.6,
    ),
    Template(
        "bsd-notice",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        0.5,
    ),
    Template(
        "mpl-notice",
        "This Source Code Form is subject to the terms of the Mozilla Public License",
        0.6,
    ),
)


def _pair_hash(first: Column, second: Column) -> Column:
    return F.xxhash64(first, second)


def _template_places(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    rows = []
    for number, template in enumerate(templates):
        words = template.words
        if len(words) < 2:
            raise ValueError(f"a template needs two words: {template.text!r}")
        rows += [(number, i, a, b) for i, (a, b) in enumerate(zip(words, words[1:], strict=False))]
    if len(rows) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"more than {MAX_TEMPLATE_WORDS} template words")
    table = docs.sparkSession.createDataFrame(
        [*rows, (-1, 0, None, None)],
        "template int, place int, t_first string, t_second string",
    )
    return table.withColumn("hash", _pair_hash(F.col("t_first"), F.col("t_second")))


def _parts_of_long_span(span: Callable[[Column, Column, Column], Column]) -> Column:
    """The spans inside a merged span that is longer than its template allows.

    From each diagonal on, the diagonals so near that they keep the length are taken
    together, unless that diagonal alone covers enough.  Of those that cover enough and
    overlap, the best stays, of equals the first.
    """

    def alone(part: Column) -> Column:
        at, voters = part["diagonal"], part["voters"]
        return span(at + F.array_min(voters), at + F.array_max(voters) + 2, voters)

    def together(near: Column) -> Column:
        return span(
            F.array_min(F.transform(near, lambda p: p["diagonal"] + F.array_min(p["voters"]))),
            F.array_max(F.transform(near, lambda p: p["diagonal"] + F.array_max(p["voters"]))) + 2,
            F.array_distinct(F.flatten(F.transform(near, lambda p: p["voters"]))),
        )

    def best_from(part: Column, i: Column) -> Column:
        # Diagonals differ, so no more than these can lie so near.
        near = F.filter(
            F.slice("parts", i + 1, F.col("pairs") + 2),
            lambda p: p["diagonal"] <= part["diagonal"] + F.col("pairs") + 1,
        )
        enough = F.size(part["voters"]) / F.col("pairs") >= F.col("needed")
        return F.when(enough, alone(part)).otherwise(together(near))

    def add(kept: Column, new: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        return (
            F.when(last.isNull() | (new["start"] >= last["stop"]), F.concat(kept, F.array(new)))
            .when(
                new["cover"] > last["cover"],
                F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(new)),
            )
            .otherwise(kept)
        )

    every = F.filter(
        F.transform("parts", best_from), lambda s: s["cover"] >= F.col("needed")
    )
    return F.aggregate(F.array_sort(every), F.slice(every, 1, 0), add)


def scan_licenses(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    phrases: Sequence[Template] = PHRASES,
    notices: Sequence[Template] = NOTICES,
) -> DataFrame:
    """One row per document: ``id_column``, ``n_words`` and ``spans`` of templates found.

    A span has ``template`` (its number), ``label``, ``is_phrase``, ``start`` and ``stop``
    (words from 0, stop excluded) and ``cover``, the share of the template's word pairs.
    """
    templates = [*phrases, *notices]
    places = _template_places(docs, templates)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(whole).alias("text_hash"),
        F.regexp_extract_all(ascii_lower(whole), F.lit(WORD), F.lit(0)).alias("words"),
    ).withColumn("n_words", F.size("words").cast("long"))
    # One more pair of nulls stands for the document itself and always finds its match.
    pairs = F.concat(
        F.arrays_zip(
            F.col("words").alias("first"),
            F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))).alias("second"),
        ),
        F.array(
            F.struct(F.lit(None).cast("string").alias("first"), F.lit(None).cast("string").alias("second"))
        ),
    )
    rolled = words.select("id", "text_hash", "n_words", F.posexplode(pairs)).select(
        "id",
        "text_hash",
        "n_words",
        F.col("pos").alias("at"),
        F.col("col.first").alias("first"),
        F.col("col.second").alias("second"),
        _pair_hash(F.col("col.first"), F.col("col.second")).alias("hash"),
    )
    same = F.col("first").eqNullSafe(F.col("t_first")) & F.col("second").eqNullSafe(
        F.col("t_second")
    )
    hits = (
        rolled.join(F.broadcast(places), "hash")
        .filter(same)
        .select(
            "id",
            "text_hash",
            "n_words",
            "template",
            F.when(F.col("template") >= 0, F.col("at") - F.col("place")).alias("diagonal"),
            "place",
        )
    )
    document = ["id", "text_hash", "n_words"]
    voted = (
        # Votes are put together where they are found, so repeated rows are few behind it.
        hits.groupBy(*document, "template", "diagonal")
        .agg(F.collect_set("place").alias("voters"), F.count("*").alias("rows"))
    )
    pair_count = F.array(*[F.lit(len(t.words) - 1) for t in templates])
    cover = F.array(*[F.lit(float(t.cover)) for t in templates])
    label = F.array(*[F.lit(t.label) for t in templates])
    is_phrase = F.col("template") < len(phrases)

    by_diagonal = Window.partitionBy(*document, "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    begins = F.when(apart <= F.when(is_phrase, 0).otherwise(DRIFT), 0).otherwise(1)
    merged = (
        voted.withColumn("span", begins)
        .withColumn("span", F.sum("span").over(by_diagonal))
        .groupBy(*document, "template", "span")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("voters"))).alias("voters"),
            F.min(F.col("diagonal") + F.array_min("voters")).alias("start"),
            (F.max(F.col("diagonal") + F.array_max("voters")) + 2).alias("stop"),
            F.sum("rows").alias("rows"),
            F.collect_list(F.struct("diagonal", "voters")).alias("parts"),
        )
        .withColumn("pairs", F.get(pair_count, F.col("template")))
        .withColumn("needed", F.get(cover, F.col("template")))
        .withColumn("parts", F.array_sort("parts"))
    )

    def span(start: Column, stop: Column, voters: Column) -> Column:
        return F.struct(
            start.alias("start"),
            stop.alias("stop"),
            F.col("template"),
            F.get(label, F.col("template")).alias("label"),
            is_phrase.alias("is_phrase"),
            (F.size(voters) / F.col("pairs")).alias("cover"),
        )

    short = F.col("stop") - F.col("start") <= 2 * (F.col("pairs") + 1)
    whole_span = F.array(span(F.col("start"), F.col("stop"), F.col("voters")))
    spans = F.filter(
        F.when(short, whole_span).otherwise(_parts_of_long_span(span)),
        lambda s: s["cover"] >= F.col("needed"),
    )
    found = merged.groupBy(*document).agg(
        F.sort_array(
            F.flatten(F.collect_list(F.when(F.col("template") >= 0, spans)))
        ).alias("spans"),
        F.max(F.when(F.col("template") == -1, F.col("rows"))).alias("times"),
    )
    return found.select(
        F.col("id").alias(id_column),
        "n_words",
        "spans",
        F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"),
    ).drop("copy")


def license_digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts, places and labels of the spans of each document."""
    base = F.filter("spans", lambda s: s["is_phrase"])

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["start"].cast("long"))
    return found.select(
        id_column,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(
            F.array_max(F.transform("spans", lambda s: s["cover"].cast("double"))), F.lit(0.0)
        ).alias("score"),
    )
