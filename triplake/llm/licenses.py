"""Licence scans by sentence rules: sentences to known sentence identifiers, identifier sequences to ordered rules.

Texts are cut into fragments at line breaks and at `.`, `;`, `!` or `?` before white space, and normalised (lower case,
anything but letters, digits and dots before digits is one space, and so are comment marks). A known sentence is a
pattern of one normalised fragment or of several that follow each other, as in hard-wrapped texts: sentences go on over
single line breaks and `;`, never over `.`, `!`, `?` or a line without letters and digits. A sentence has the number of
its first fragment and one identifier, that of the first pattern it fits. The SQL oracle knows sentences of one fragment
only; on texts whose known sentences are not wrapped both agree. The sequence
of a text's identifiers is matched against the rules: a rule is a licence and an ordered list of identifiers that must
stand next to each other in the sequence. Rules are tried in order, longer ones first by convention; the places of a
matched rule are used up, so that a short rule does not report what a longer one has explained.

Defined results: null and empty texts, and texts without a known sentence, have empty lists; repeated rows get equal
results; other columns pass through untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.shared import let

#: Known sentences: identifier and pattern of the whole normalised sentence. Fixed values, public licence phrases.
SENTENCES = (
    ("apache-2.0-grant", r"licensed under the apache licen[sc]e version 2(\.0)?( the licen[sc]e)?"),
    ("apache-compliance", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache-copy", r"you may obtain a copy of the licen[sc]e at.*"),
    ("as-is", r"(unless required by applicable law or agreed to in writing )?software distributed under the licen[sc]e is distributed on an as is basis.*"),
    ("mit-name", r"(this (work|code|software|project) is )?(released|licensed|available|distributed) under the (terms of the )?mit licen[sc]e"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy.*"),
    ("mit-condition", r"the above copyright notice and this permission notice shall be included in all copies.*"),
    ("mit-disclaimer", r"the software is provided as is without warranty of any kind.*"),
    ("gpl-3-name", r"(this (work|program|code|software) is )?licensed under the gnu general public licen[sc]e version 3( or later)?"),
    ("gpl-grant", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e.*"),
    ("gpl-warranty", r"this program is distributed in the hope that it will be useful.*"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted.*"),
    ("bsd-disclaimer", r"this software is provided by the copyright holders and contributors as is.*"),
    ("cc-by-nc-4.0-name", r"(this work is )?licensed under (a )?(cc by nc|creative commons attribution non ?commercial) 4(\.0)?( international)?( licen[sc]e)?"),
    ("cc-by-sa-4.0-name", r"(this work is )?licensed under (a )?(cc by sa|creative commons attribution share ?alike) 4(\.0)?( international)?( licen[sc]e)?"),
    ("cc-by-4.0-name", r"(this work is )?licensed under (a )?(cc by|creative commons attribution) 4(\.0)?( international)?( licen[sc]e)?"),
    ("all-rights", r"all rights reserved"),
)

#: Rules in the order they are tried: licence, and identifiers that follow each other. Fixed values.
RULES = (
    ("Apache-2.0", ("apache-2.0-grant", "apache-compliance", "apache-copy", "as-is")),
    ("Apache-2.0", ("apache-2.0-grant", "apache-compliance")),
    ("MIT", ("mit-name", "mit-grant", "mit-condition", "mit-disclaimer")),
    ("MIT", ("mit-grant", "mit-condition", "mit-disclaimer")),
    ("GPL-3.0", ("gpl-3-name", "gpl-grant", "gpl-warranty")),
    ("GPL", ("gpl-grant", "gpl-warranty")),
    ("BSD", ("bsd-grant", "bsd-disclaimer")),
    ("Apache-2.0", ("apache-2.0-grant",)),
    ("MIT", ("mit-name",)),
    ("GPL-3.0", ("gpl-3-name",)),
    ("GPL", ("gpl-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-name",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0-name",)),
    ("CC-BY-4.0", ("cc-by-4.0-name",)),
    ("proprietary", ("all-rights",)),
)

#: Words of which every known sentence has one; other texts are not normalised. Fixed values.
HINTS = r"(?i)licen[sc]e|permission|software|program|redistribution|reserved"

SPLIT = r"\n|[.;!?]+(?:\s|\z)"
NOISE = r"[^\p{L}\p{N}.]+"
STOP = r"\.(\P{N}|\z)"

#: Where no sentence goes on: the break before a line without letters and digits, and a sentence's end.
BLANK = r"\n(?=[^\p{L}\p{N}\n]*\n)"
FULL_STOP = r"(?<![.;!?]);*+[.!?][.;!?]*+(\s|\z)"
MARK = "\x01"


@dataclass(frozen=True)
class Rulebook:
    sentences: tuple = SENTENCES
    rules: tuple = RULES
    hints: str = HINTS


def normalised(sentence: Column) -> Column:
    words = F.regexp_replace(F.regexp_replace(F.lower(sentence), NOISE, " "), STOP, " $1")
    return F.trim(F.regexp_replace(words, " +", " "))


def wrapped(pattern: str) -> str:
    """pattern over lines of fragments, each behind its number and a bar; a space may be the start of the next fragment."""
    return re.sub(" ", r"(?: |\\n[0-9]+\\|)", pattern.replace(".*", r"[^\n#]*"))


def sentence_ids(text: Column, book: Rulebook = Rulebook()) -> Column:
    """array<struct<pos, id>>: number of the first fragment and identifier of every known sentence of the text."""

    def known(n: Column) -> Column:
        return F.coalesce(*(F.when(n.rlike(f"^(?:{pattern})$"), F.lit(name)) for name, pattern in book.sentences))

    # Marks add no fragment: numbers are those of the plain split.
    marked = F.regexp_replace(F.regexp_replace(F.translate(text, MARK, " "), BLANK, "\n" + MARK), FULL_STOP, MARK + ";$1")
    parts = F.transform(F.split(marked, SPLIT), lambda s, i: F.struct(i.alias("pos"), normalised(s).alias("n"), F.when(F.contains(s, F.lit(MARK)), "#").otherwise("").alias("end")))
    parts = F.filter(parts, lambda p: (p["n"] != "") | (p["end"] != ""))
    lines = F.array_join(F.transform(parts, lambda p: F.concat(p["pos"].cast("string"), F.lit("|"), p["n"], p["end"])), "\n")
    fits = "(?m)^[0-9]+\\|(?:" + "|".join(wrapped(pattern) for _, pattern in book.sentences) + ")(?=#?$)"
    found = F.regexp_extract_all(lines, F.lit(fits), F.lit(0))
    words = lambda m: F.regexp_replace(m, r"(^|\n)[0-9]+\|", " ")
    named = F.transform(found, lambda m: F.struct(F.substring_index(m, "|", 1).cast("int").alias("pos"), let(F.trim(words(m)), known).alias("id")))
    return F.when(text.rlike(book.hints), F.filter(named, lambda p: p["id"].isNotNull())).otherwise(F.expr("cast(array() as array<struct<pos:int,id:string>>)"))


def rule_matches(ids: Column, book: Rulebook = Rulebook()) -> Column:
    """array<string> of licences whose rule the identifiers fit, in the order of the rules, each once.

    Identifiers are written between bars; a matched rule leaves a mark in its place that no rule contains.
    """
    said = F.concat(F.lit("|"), F.array_join(F.transform(ids, lambda p: F.concat(p["id"], F.lit("|"))), "|"))
    start = F.struct(said.alias("rest"), F.expr("cast(array() as array<string>)").alias("found"))
    steps = F.array(*(F.struct(F.lit(licence).alias("licence"), F.lit("|" + "||".join(rule) + "|").alias("rule")) for licence, rule in book.rules))

    def tried(acc: Column, step: Column) -> Column:
        fits = F.contains(acc["rest"], step["rule"])
        return F.struct(F.replace(acc["rest"], step["rule"], F.lit("|#|")).alias("rest"), F.when(fits, F.concat(acc["found"], F.array(step["licence"]))).otherwise(acc["found"]).alias("found"))

    found = F.aggregate(steps, start, tried, lambda acc: F.array_distinct(acc["found"]))
    return F.when(F.size(ids) > 0, found).otherwise(F.expr("cast(array() as array<string>)"))


def scan(docs: DataFrame, book: Rulebook = Rulebook()) -> DataFrame:
    """docs with _sentences (numbers and identifiers of known sentences) and _licences."""
    ids = sentence_ids(F.coalesce("text", F.lit("")), book)
    found = docs.withColumn("_sentences", ids)
    return found.withColumn("_licences", rule_matches(F.col("_sentences"), book))


def oracle(book: Rulebook = Rulebook()) -> str:
    """DuckDB SQL over `documents`: doc_id, n_sentences, sentences and licences, as op3 returns them."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = " ".join(f"when regexp_full_match(s, {quoted(p)}) then {quoted(n)}" for n, p in book.sentences)
    steps, last = [], "sequences"
    for k, (licence, rule) in enumerate(book.rules):
        said = quoted("|" + "||".join(rule) + "|")
        steps.append(f"rule{k} as (select * exclude (rest), replace(rest, {said}, '|#|') as rest, case when contains(rest, {said}) then {quoted(licence)} end as l{k} from {last})")
        last = f"rule{k}"
    found = ", ".join(f"l{k}" for k in range(len(book.rules)))
    clean = f"trim(regexp_replace(regexp_replace(regexp_replace(lower(part), {quoted(NOISE)}, ' ', 'g'), {quoted(STOP)}, ' \\1', 'g'), ' +', ' ', 'g'))"
    return f"""
with parts as (select row_number() over () as row, doc_id, string_split_regex(coalesce(text, ''), {quoted(SPLIT)}) as parts from documents),
sentences as (select row, unnest(range(len(parts))) as pos, unnest(parts) as part from parts),
named as (select row, pos, case {known} end as id from (select row, pos, {clean} as s from sentences)),
sequences as (select row, count(*) as n, string_agg(pos || ':' || id, ' ' order by pos) as sentences, '|' || string_agg(id || '|', '|' order by pos) as rest from named where id is not null group by row),
{", ".join(steps)}
select p.doc_id, coalesce(r.n, 0)::bigint as n_sentences, coalesce(r.sentences, '') as sentences,
  coalesce(array_to_string(list_sort(list_distinct(list_filter([{found}], lambda x: x is not null))), ','), '') as licences
from parts p left join {last} r using (row)"""
