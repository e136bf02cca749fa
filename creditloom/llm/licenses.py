"""License scans: an exact set-similarity join of text blocks with license notices."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import whole_text, words_of

# Phrases of the base labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Public license notices, as words, with their labels.
TEMPLATES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
]

CONTAINMENT = 0.8

_BASE = pa.list_(pa.struct([("first_word", pa.int64()), ("label", pa.string())]))
_BLOCKS = pa.list_(
    pa.struct(
        [("template", pa.int32()), ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("share", pa.float64())]
    )
)
_FOUND = (
    "doc_id long, n_words long, base array<struct<first_word: long, label: string>>, "
    "blocks array<struct<template: int, label: string, first_word: long, last_word: long, share: double>>"
)


class _Template:
    """A notice as a set of tokens, rarest first."""

    def __init__(self, number: int, text: str, label: str, counts: dict[bytes, int], least: float):
        words = text.encode().split()
        self.number, self.label, self.block = number, label, 2 * len(words)
        self.tokens = sorted(set(words), key=lambda t: (counts.get(t, 0), t))
        self.need = math.ceil(least * len(self.tokens) - 1e-9)
        # a set of tokens with `need` of these has one of the first len - need + 1 (prefix filter)
        self.prefix = self.tokens[: len(self.tokens) - self.need + 1]

    def reaches(self, places: dict[bytes, list[int]]) -> list[tuple[int, int]]:
        """First and last word of the stretches that hold all blocks that may match, apart from each other.

        A block that matches has a rarest token, in the prefix. From its place in the order on, as many tokens as are
        needed must stand in the words that a block around it can reach (positional filter).
        """
        out: list[tuple[int, int]] = []
        for rank, token in enumerate(self.prefix):
            for at in places.get(token, ()):
                first, last = at - self.block + 1, at + self.block - 1
                met = 0
                for other in self.tokens[rank:]:
                    own = places.get(other, ())
                    i = bisect_left(own, first)
                    met += i < len(own) and own[i] <= last
                if met >= self.need:
                    out.append((first, last))
        return _united(sorted(out))

    def matches(self, places: dict[bytes, list[int]], n_words: int) -> list[tuple[int, int, int]]:
        """(first word, last word, most tokens in a block) of every run of overlapping blocks that match."""
        if n_words < self.need:  # length filter
            return []
        spans = []
        for first, last in self.reaches(places):
            met = []
            for token in self.tokens:
                own = places.get(token, ())
                met += [(at, token) for at in own[bisect_left(own, first) : bisect_left(own, last + 1)]]
            met.sort()
            seen: Counter = Counter()
            left = 0
            for at, token in met:
                seen[token] += 1
                while met[left][0] <= at - self.block:
                    old = met[left][1]
                    seen[old] -= 1
                    if not seen[old]:
                        del seen[old]
                    left += 1
                if len(seen) >= self.need:
                    spans.append((met[left][0], at, len(seen)))
        out: list[tuple[int, int, int]] = []
        for first, last, most in spans:
            if out and first <= out[-1][1]:
                out[-1] = (out[-1][0], last, max(out[-1][2], most))
            else:
                out.append((first, last, most))
        return out


def _united(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in ranges:
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _token_counts(batches: Iterator[pa.RecordBatch], tokens: frozenset[bytes]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").cast(pa.binary()):
            counts.update(filter(tokens.__contains__, words_of(text.as_py())))
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "n"])


def _base_places(words: list[bytes], own: set[bytes]) -> list[tuple[int, str]]:
    places = []
    for phrase, label in PHRASES.items():
        parts = phrase.encode().split()
        if own.issuperset(parts):
            at = -1
            for _ in range(words.count(parts[0])):
                at = words.index(parts[0], at + 1)
                if words[at : at + len(parts)] == parts:
                    places.append((at, label))
    return places


def _scan(batches: Iterator[pa.RecordBatch], counts: dict[bytes, int], least: float) -> Iterator[pa.RecordBatch]:
    templates = [_Template(i, text, label, counts, least) for i, (text, label) in enumerate(TEMPLATES)]
    # inverted index: prefix token to the templates that it may open
    index: dict[bytes, list[_Template]] = {}
    for template in templates:
        for token in template.prefix:
            index.setdefault(token, []).append(template)
    tokens = frozenset(t for x in templates for t in x.tokens)
    opening = frozenset(index) | {p.encode().split()[0] for p in PHRASES}
    for batch in batches:
        out: list[list] = [[] for _ in range(3)]
        for text in batch.column("text").cast(pa.binary()):
            words = words_of(text.as_py())
            own = opening.intersection(words)
            base: list[tuple[int, str]] = []
            blocks: list[dict] = []
            if own:
                places: dict[bytes, list[int]] = {}
                for at, word in enumerate(words):
                    if word in tokens:
                        places.setdefault(word, []).append(at)
                base = _base_places(words, set(places) | own)
                for template in {x.number: x for t in own for x in index.get(t, ())}.values():
                    for first, last, most in template.matches(places, len(words)):
                        share = most / len(template.tokens)
                        at = {"first_word": first, "last_word": last}
                        blocks.append({"template": template.number, "label": template.label, **at, "share": share})
            blocks.sort(key=lambda x: (x["first_word"], x["last_word"], x["template"]))
            row = (len(words), [{"first_word": at, "label": label} for at, label in sorted(base)], blocks)
            for column, value in zip(out, row):
                column.append(value)
        columns = [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, (pa.int64(), _BASE, _BLOCKS)))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "base", "blocks"])


def find(docs: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, n_words, base, blocks): base places and matching blocks of every row of ``docs``, by place.

    base has the first word and label of every phrase. A block, any run of twice a template's words, matches if it holds
    at least ``containment`` of the template's different tokens; blocks has, for every run of overlapping blocks that
    match a template, the template's number and label, the first and last of its tokens there, and the
    largest share of its tokens in one block. All such runs are found, and runs of different templates stand by themselves.

    Tokens are ordered by their number in all texts, rarest first. Only texts with a token of a template's prefix, and
    as many words as it needs, are compared with it, and only around places of such tokens in whose reach enough
    tokens of the rest stand. Templates are a fixed list, so every task holds their index; texts are not shuffled.

    Words: A-Z lower-cased runs of digits, letters and non-ASCII characters, from 0. Null and empty texts have no words
    and empty lists; repeated rows are rows of their own; extra columns are ignored; an empty table gives an
    empty result.
    """
    texts = docs.select("doc_id", whole_text().alias("text"))
    tokens = frozenset(t for text, _ in TEMPLATES for t in text.encode().split())
    counts = texts.select("text").mapInArrow(partial(_token_counts, tokens=tokens), "token binary, n long")
    counts = counts.groupBy("token").agg(F.sum("n").alias("n")).collect()  # one row per token of the templates
    order = {bytes(r["token"]): r["n"] for r in counts}
    return texts.mapInArrow(partial(_scan, counts=order, least=containment), _FOUND)


def scan(docs: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_links) of every row of ``docs``.

    A summary of ``find``, whose rules hold: number, first and last of the base places, labels of these and of all,
    the largest share of a template's tokens (1 with a base place, 0 without any), number of templates that match.
    """
    found = find(docs, containment)
    base, starts = F.col("base.label"), F.col("base.first_word")

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    share = F.coalesce(F.array_max("blocks.share"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.col("blocks.label"))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(share).alias("score"),
        F.size(F.array_distinct("blocks.template")).cast("long").alias("n_links"),
    )


def scan_sql(table: str = "documents", containment: float = CONTAINMENT) -> str:
    """The rows of ``scan`` in DuckDB SQL, by comparing every block with every template."""
    templates = ", ".join(f"({i}, '{label}', '{text}')" for i, (text, label) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{label}', string_split('{text}', ' '))" for text, label in PHRASES.items())
    return f"""
with t(id, label, words) as (values {templates}),
k as (select id, label, 2 * len(string_split(words, ' ')) as block, unnest(list_distinct(string_split(words, ' '))) as tok from t),
z as (select id, count(*) as size from k group by id),
p(label, words) as (values {phrases}),
d as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from {table}
), w as (select rid, unnest(ws) as tok, generate_subscripts(ws, 1) - 1 as pos from d),
b as (
  select w.rid, w.pos, p.label from w join p on w.tok = p.words[1] join d on d.rid = w.rid
  where list_slice(d.ws, w.pos + 1, w.pos + len(p.words)) = p.words
), bb as (
  select rid, count(*) as n, min(pos) as lo, max(pos) as hi, string_agg(distinct label, ',' order by label) as labels from b group by rid
), m as (
  select w.rid, k.id, k.label, count(distinct w.tok) over (partition by w.rid, k.id order by w.pos
    range between current row and k.block - 1 following) as met from w join k using (tok)
), l as (
  select m.rid, m.id, m.label, max(met) / cast(z.size as double) as share from m join z using (id)
  group by m.rid, m.id, m.label, z.size having max(met) >= ceil({containment} * z.size - 1e-9)
), ll as (select rid, count(*) as n, max(share) as share from l group by rid),
a as (
  select rid, string_agg(distinct label, ',' order by label) as labels
  from (select rid, label from l union all select rid, label from b) group by rid
)
select d.doc_id, cast(len(d.ws) as bigint) as n_words, cast(coalesce(bb.n, 0) as bigint) as n_base,
  cast(bb.lo as bigint) as first_word, cast(bb.hi as bigint) as last_word, coalesce(bb.labels, '') as base_labels,
  coalesce(a.labels, '') as labels, case when bb.n > 0 then 1.0 else coalesce(ll.share, 0.0) end as score,
  cast(coalesce(ll.n, 0) as bigint) as n_links
from d left join bb using (rid) left join ll using (rid) left join a using (rid)
"""
