"""Licence scans by sentences and ordered rules.

A text is cut into sentences and each is normalised. A sentence gives the identifiers of all known
licence sentences it holds, in order of position, since a colon, a list mark or an empty line does not
end it; other sentences that speak of a licence give ``unknown``. The document's sequence of
identifiers is then matched against rules in order: a rule consumes the identifiers it matches,
so that what a full licence text explains is not counted again by the rule for a mere reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, normalised (lower case, only letters, digits and full
# stops within numbers). Of those that begin at one place, the first gives its identifier.
SENTENCES = [
    ("mit.grant", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit.notice", "the above copyright notice and this permission notice shall be included in all copies"),
    ("isc.grant", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd.grant", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd.source", "redistributions of source code must retain the above copyright notice"),
    ("bsd.binary", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd.name", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("as.is", "is provided as is without warranty of any kind"),
    ("as.is", "software is provided by the copyright holders and contributors as is"),
    ("apache.terms", "you may not use this file except in compliance with the license"),
    ("apache.copy", "you may obtain a copy of the license at"),
    ("apache.ref", "licensed under the apache license version 2.0"),
    ("gpl.later", "either version 3 of the license or at your option any later version"),
    ("gpl.redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl.ref", "gnu lesser general public license"),
    ("agpl.ref", "gnu affero general public license"),
    ("gpl3.ref", "gnu general public license version 3"),
    ("gpl2.ref", "gnu general public license version 2"),
    ("gpl.ref", "gnu general public license"),
    ("mpl2.ref", "mozilla public license version 2.0"),
    ("mpl2.ref", "mozilla public license v. 2.0"),
    ("mit.ref", "mit license"),
    ("bsd.ref", "bsd license"),
    ("ccbyncsa4.ref", "licensed under cc by nc sa 4.0"),
    ("ccbync4.ref", "licensed under cc by nc 4.0"),
    ("ccbysa4.ref", "licensed under cc by sa 4.0"),
    ("ccby4.ref", "licensed under cc by 4.0"),
    ("cc0.ref", "creative commons zero"),
    ("reserved", "all rights reserved"),
]
# Licence names and the sequences of identifiers that show them, in order of precedence.
RULES = [
    ("MIT", ["mit.grant", "mit.notice", "as.is"]),
    ("MIT", ["mit.grant", "mit.notice"]),
    ("BSD-3-Clause", ["bsd.grant", "bsd.source", "bsd.binary", "bsd.name", "as.is"]),
    ("BSD-2-Clause", ["bsd.grant", "bsd.source", "bsd.binary", "as.is"]),
    ("ISC", ["isc.grant", "as.is"]),
    ("Apache-2.0", ["apache.ref", "apache.terms", "apache.copy"]),
    ("GPL-3.0-or-later", ["gpl.redistribute", "gpl.later"]),
    ("Apache-2.0", ["apache.ref"]),
    ("LGPL", ["lgpl.ref"]),
    ("AGPL", ["agpl.ref"]),
    ("GPL-3.0", ["gpl3.ref"]),
    ("GPL-2.0", ["gpl2.ref"]),
    ("GPL", ["gpl.redistribute"]),
    ("GPL", ["gpl.ref"]),
    ("MPL-2.0", ["mpl2.ref"]),
    ("MIT", ["mit.ref"]),
    ("BSD", ["bsd.ref"]),
    ("CC-BY-NC-SA-4.0", ["ccbyncsa4.ref"]),
    ("CC-BY-NC-4.0", ["ccbync4.ref"]),
    ("CC-BY-SA-4.0", ["ccbysa4.ref"]),
    ("CC-BY-4.0", ["ccby4.ref"]),
    ("CC0-1.0", ["cc0.ref"]),
    ("Proprietary", ["reserved"]),
]
#: Sentences and rules that the SQL twin does not have: it names one identifier per sentence.
MORE_SENTENCES = [
    ("isc.grant", "permission to use copy modify and distribute this software for any purpose"),
    ("as.is", "is provided as is and the author disclaims all warranties"),
]
MORE_RULES = [
    ("BSD-3-Clause", ["reserved", "bsd.grant", "bsd.source", "bsd.binary", "bsd.name", "as.is"]),
    ("BSD-2-Clause", ["reserved", "bsd.grant", "bsd.source", "bsd.binary", "as.is"]),
    ("GPL-3.0-or-later", ["gpl.redistribute", "gpl.later", "gpl.ref", "gpl.ref"]),
    ("GPL-3.0-or-later", ["gpl.redistribute", "gpl.later", "gpl.ref"]),
    ("GPL-3.0", ["gpl.redistribute", "gpl3.ref"]),
    ("GPL-2.0", ["gpl.redistribute", "gpl2.ref"]),
]
#: Every known sentence and every unknown one worth a report holds one of these.
TRIGGER = "licen[cs]e|copyright|permission|redistribut|warranty|as is|creative commons|rights reserved"
UNKNOWN = "licen[cs]e|copyright"


def sentences(text: Column) -> Column:
    """Normalised sentences: they end at . ! ? or ; before white space."""
    ended = F.regexp_replace(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "), "([.!?;]) ", "$1\n")
    return F.transform(F.split(ended, "\n"), lambda s: F.trim(F.regexp_replace(F.regexp_replace(s, "[^a-z0-9.]+", " "), "[.]$", "")))


def sentence_ids(sentence: Column) -> Column:
    """Identifiers of a normalised sentence in order of position, ``unknown`` alone, or none when it has nothing to do with licences."""
    known = SENTENCES + MORE_SENTENCES
    names = F.create_map(*(F.lit(x) for name, phrase in known for x in (phrase, name)))
    # The match is empty, so that sentences which overlap are all found.
    phrases = F.regexp_extract_all(sentence, F.lit("(?=(" + "|".join(p.replace(".", "[.]") for _, p in known) + "))"), F.lit(1))
    ids = F.transform(phrases, lambda p: F.element_at(names, p))
    # The GPL's grant ends with the GPL's name.
    ids = F.filter(ids, lambda i, k: ~((i == "gpl.ref") & (k > 0) & (F.get(ids, k - 1) == "gpl.redistribute")))
    return F.when(F.size(ids) > 0, ids).when(sentence.rlike(UNKNOWN), F.array(F.lit("unknown"))).otherwise(F.array().cast("array<string>"))


def rule_pattern(ids: list[str]) -> str:
    return "".join("<" + i.replace(".", "[.]") + ">" for i in ids)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, licenses, sentence_ids, n_known, n_unknown``, one row per row with any licence sentence.

    ``licenses`` lists the names found, each once, in the order of the rules, separated by commas;
    it is empty where only unmatched sentences remain. ``sentence_ids`` is the sequence as
    ``<id><id>...``. Only ``doc_id`` and ``text`` are read; null and empty texts give no row.
    """
    hit = F.lower("text").rlike("licen[cs]e|copyright|permission|redistribut|warranty|as[^a-z0-9]+is|creative|reserved")
    ids = F.flatten(F.transform(F.filter(sentences(F.col("text")), lambda s: s.rlike(TRIGGER)), sentence_ids))
    found = docs.select("doc_id", "text").where(hit).select("doc_id", ids.alias("ids")).where(F.size("ids") > 0)
    found = found.select(
        "doc_id",
        F.concat_ws("", F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">")))).alias("sentence_ids"),
        F.size(F.filter("ids", lambda i: i != "unknown")).alias("n_known"),
        F.size(F.filter("ids", lambda i: i == "unknown")).alias("n_unknown"),
    ).withColumn("_left", F.col("sentence_ids"))
    hits: dict[str, Column] = {name: F.lit(False) for name, _ in RULES}
    for k, (name, sequence) in enumerate(MORE_RULES + RULES):
        pattern = rule_pattern(sequence)
        found = found.withColumn(f"_r{k}", F.col("_left").rlike(pattern))
        hits[name] = hits[name] | F.col(f"_r{k}")
        found = found.withColumn("_left", F.regexp_replace("_left", pattern, "|"))
    names = F.concat_ws(",", *(F.when(hit, name) for name, hit in hits.items()))
    return found.select("doc_id", names.alias("licenses"), "sentence_ids", "n_known", "n_unknown")


def scan_sql(table: str = "documents") -> str:
    """SQL with the first identifier of each sentence alone: the same where no sentence holds two or one of ``MORE_SENTENCES``."""
    case = " ".join(f"WHEN contains(s, '{phrase}') THEN '{name}'" for name, phrase in SENTENCES)
    steps, left, names = [], "sentence_ids", {}
    for k, (name, sequence) in enumerate(RULES):
        pattern = rule_pattern(sequence)
        steps.append(f"l{k} AS (SELECT *, regexp_matches(w{k}, '{pattern}') AS r{k}, regexp_replace(w{k}, '{pattern}', '|', 'g') AS w{k + 1} FROM l{k - 1})")
        names.setdefault(name, []).append(f"r{k}")
    found = ", ".join(f"CASE WHEN {' OR '.join(rs)} THEN '{name}' END" for name, rs in names.items())
    return rf"""
WITH cut AS (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(lower(text), '[\x20\x09-\x0D]+', ' ', 'g'), '([.!?;]) ', '\1' || chr(10), 'g'), chr(10)) AS parts
  FROM {table}
), plain AS (
  SELECT doc_id, list_transform(parts, lambda p: trim(regexp_replace(regexp_replace(p, '[^a-z0-9.]+', ' ', 'g'), '[.]$', ''))) AS parts FROM cut
), named AS (
  SELECT doc_id, list_filter(list_transform(list_filter(parts, lambda s: regexp_matches(s, '{TRIGGER}')),
         lambda s: CASE {case} WHEN regexp_matches(s, '{UNKNOWN}') THEN 'unknown' END), lambda i: i IS NOT NULL) AS ids FROM plain
), l_base AS (
  SELECT doc_id, '<' || array_to_string(ids, '><') || '>' AS sentence_ids,
         CAST(len(list_filter(ids, lambda i: i <> 'unknown')) AS INTEGER) AS n_known,
         CAST(len(list_filter(ids, lambda i: i = 'unknown')) AS INTEGER) AS n_unknown FROM named WHERE len(ids) > 0
), "l-1" AS (SELECT *, {left} AS w0 FROM l_base), {", ".join(steps).replace("FROM l-1", 'FROM "l-1"')}
SELECT doc_id, concat_ws(',', {found}) AS licenses, sentence_ids, n_known, n_unknown FROM l{len(RULES) - 1}
"""
