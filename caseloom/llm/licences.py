"""Licence recognition by sentences and rules.

A text is cut into normalised pieces. The words a piece starts with are looked up in a hashed map
of known licence sentences; what is found there is compared with the run of pieces, as sentences
may be wrapped over lines. The sequence of their identifiers is matched against ordered licence
rules. Built-in functions only; the cost does not follow the number of known sentences.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import let

# Widely published licence sentences, lower-cased, without punctuation. A star
# stands for names of up to ``STAR_CHARS`` characters.
SENTENCES = {
    "mit-named": ["released under the mit license", "licensed under the mit license",
                  "this project is licensed under the mit license"],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in "
                   "all copies or substantial portions of the software"],
    "apache2-named": ["licensed under the apache license version 2 0",
                      "released under the apache license version 2 0"],
    "apache2-head": ["licensed under the apache license version 2 0 the license"],
    "apache2-use": ["you may not use this file except in compliance with the license"],
    "gpl3-named": ["this work is licensed under the gnu general public license version 3",
                   "licensed under the gnu general public license version 3"],
    "gpl3-head": [
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version"],
    "gpl-hope": [
        "this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose"],
    "cc-by-nc4": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0"],
    "cc-by4": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this "
                   "list of conditions and the following disclaimer"],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution"],
    "mpl2-head": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "bsd-name": ["neither the name of * may be used to endorse or promote products derived from this "
                 "software without specific prior written permission",
                 "the name of * may not be used to endorse or promote products derived from this "
                 "software without specific prior written permission"],
    "isc-grant": [
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted provided that the above copyright notice and this permission notice "
        "appear in all copies",
        "permission to use copy modify and distribute this software for any purpose with or without "
        "fee is hereby granted provided that the above copyright notice and this permission notice "
        "appear in all copies"],
    "gpl2-head": [
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 2 of the license or at your option any later version"],
    "gpl2-only": [
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license version 2 as published by the free software foundation"],
    "lgpl21-head": [
        "this library is free software you can redistribute it and or modify it under the terms "
        "of the gnu lesser general public license as published by the free software foundation either "
        "version 2 1 of the license or at your option any later version"],
    "lgpl3-head": [
        "this library is free software you can redistribute it and or modify it under the terms "
        "of the gnu lesser general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version"],
    "agpl3-head": [
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu affero general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version"],
    "lgpl-hope": [
        "this library is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose"],
    "unlicense-head": ["this is free and unencumbered software released into the public domain"],
    "cc0-waiver": ["to the extent possible under law * has waived all copyright and related or neighboring "
                   "rights to this work"],
    "reserved": ["all rights reserved"],
}
#: Creative Commons licences that are named in words, and licences known by their tag.
CC_WORDS = {"by": "attribution", "nc": "noncommercial", "nd": "noderivatives", "sa": "sharealike"}
CC_KINDS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
TAGGED = ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later",
          "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later",
          "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense")
# Rules in the order in which they are tried at each place: licence and sentence sequence.
RULES = (
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache2-head", "apache2-use")),
    ("GPL-3.0-or-later", ("gpl3-head", "gpl-hope")),
    ("GPL-2.0-or-later", ("gpl2-head", "gpl-hope")),
    ("AGPL-3.0-or-later", ("agpl3-head", "gpl-hope")),
    ("LGPL-2.1-or-later", ("lgpl21-head", "lgpl-hope")),
    ("LGPL-3.0-or-later", ("lgpl3-head", "lgpl-hope")),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-name")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("MIT", ("mit-named",)),
    ("MIT", ("mit-grant",)),
    ("Apache-2.0", ("apache2-named",)),
    ("Apache-2.0", ("apache2-head",)),
    ("GPL-3.0-or-later", ("gpl3-head",)),
    ("GPL-2.0-or-later", ("gpl2-head",)),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("AGPL-3.0-or-later", ("agpl3-head",)),
    ("LGPL-2.1-or-later", ("lgpl21-head",)),
    ("LGPL-3.0-or-later", ("lgpl3-head",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense-head",)),
    ("CC0-1.0", ("cc0-waiver",)),
    ("GPL-3.0-only", ("gpl3-named",)),
    ("CC-BY-NC-4.0", ("cc-by-nc4",)),
    ("CC-BY-4.0", ("cc-by4",)),
    ("MPL-2.0", ("mpl2-head",)),
    ("all-rights-reserved", ("reserved",)),
)
for _kind in CC_KINDS:
    _words = " ".join(CC_WORDS[part] for part in _kind.split("-"))
    SENTENCES[f"cc-{_kind}-words"] = [
        f"{start} licensed under a creative commons {_words} 4 0 international license"
        for start in ("this work is", "this document is")]
    RULES += ((f"CC-{_kind.upper()}-4.0", (f"cc-{_kind}-words",)),)
for _name in TAGGED:
    SENTENCES[f"tag-{_name.lower().replace('.', '')}"] = [
        "spdx license identifier " + " ".join(_name.lower().replace("-", " ").replace(".", " ").split())]
    RULES += ((_name, (f"tag-{_name.lower().replace('.', '')}",)),)
# A piece ends at a line break, or at a mark followed by white space. A sentence is one piece or
# several, as it may be wrapped over lines or hold marks.
SENTENCE_END = r"[.!?;:]*\n|[.!?;:]\s"
# The number or letter of a list entry.
ENTRY = "(?:[0-9]{1,2}|[a-z]|[ivx]{1,5})"
#: Words that a sentence is looked up by, and characters that a star may stand for.
KEY_WORDS = 3
STAR_CHARS = 100


def pieces(text: Column) -> Column:
    """The pieces of a text, each between line breaks.

    A piece is lower case with runs of anything but ASCII letters and digits as one blank.
    Empty pieces are dropped; words of other scripts only are a piece of their own, '~'.
    """
    lines = F.regexp_replace(F.translate(F.lower(F.coalesce(text, F.lit(""))), "~", " "), SENTENCE_END, "\n")
    other = r"(?<![^\n])[^\p{L}\p{N}\n]*+[\p{L}\p{N}&&[^a-z0-9]][^a-z0-9\n]*+(?![^\n])"
    words = F.regexp_replace(F.regexp_replace(lines, other, "~"), "[^a-z0-9~\n]+", " ")
    return F.regexp_replace(F.concat(F.lit("\n"), words, F.lit("\n")), " ?\n[ \n]*", "\n")


def known_sentences(sentences: dict[str, list[str]]) -> list[tuple[str, str, str]]:
    """(head, tail, identifier) of each sentence: what stands before and after its star, if it has one."""
    return [(*[part.strip() for part in f"{text}*".split("*")[:2]], name)
            for name, texts in sentences.items() for text in texts]


def _lookup(sentences: dict[str, list[str]]):
    """A function from the first words of a piece to the sentences that start with them (or null)."""
    known = known_sentences(sentences)
    buckets: list[dict[str, list[dict]]] = [{} for _ in range(max(16, 2 * len(known)))]
    for head, tail, name in known:
        if len(head.split(" ")) < KEY_WORDS:
            raise ValueError(f"a sentence needs {KEY_WORDS} words, before its star if it has one: {name}")
        key = " ".join(head.split(" ")[:KEY_WORDS])
        held = buckets[zlib.crc32(key.encode()) % len(buckets)]
        held.setdefault(key, []).append({"head": head, "tail": tail, "name": name})
    table = F.from_json(F.lit(json.dumps(buckets)),
                        "array<map<string, array<struct<head: string, tail: string, name: string>>>>")

    def found(key: Column) -> Column:
        bucket = F.pmod(F.crc32(key.cast("binary")), F.lit(len(buckets))).cast("int")
        return F.try_element_at(F.element_at(table, bucket + 1), key)
    return found


def _starts(pieces: Column, sentences: dict[str, list[str]]) -> Column:
    """Places at which known sentences may start: place, first piece, and the sentences.

    The number of a list entry may stand before the sentence.
    """
    found = _lookup(sentences)

    def key(first: Column, i: Column) -> Column:
        following = [F.get(pieces, i + k) for k in range(1, KEY_WORDS)]
        return F.substring_index(F.concat_ws(" ", first, *following), " ", KEY_WORDS)

    def start(x: Column, i: Column) -> Column:
        bare = F.when(F.instr(x, " ").between(2, 6), F.regexp_replace(x, f"^{ENTRY} ", "")).otherwise(x)
        whole = found(key(x, i))
        return F.when(whole.isNotNull(), F.struct(i.alias("at"), x.alias("first"), whole.alias("known"))).otherwise(
            F.struct(i.alias("at"), bare.alias("first"), found(key(bare, i)).alias("known")))
    return F.filter(F.transform(pieces, start), lambda s: s["known"].isNotNull())


def _sentence_at(pieces: Column, start: Column, span: int) -> Column:
    """The longest known sentence at a start, (characters, pieces, identifier), or null."""
    rest = F.slice(pieces, start["at"] + 2, span)
    lines = F.array_join(F.concat(F.array(start["first"]), rest), "\n")

    def match(lines: Column) -> Column:
        words = F.translate(lines, "\n", " ")

        def one(known: Column) -> Column:
            head = F.length(known["head"])
            tail_at = F.call_function("locate", known["tail"], words, head + 1)
            end = F.when(known["tail"] == "", head).when(
                (tail_at > 0) & (tail_at - head <= STAR_CHARS), tail_at + F.length(known["tail"]) - 1)
            taken = F.substring(lines, F.lit(1), end)
            fits = F.startswith(words, known["head"]) & F.substring(lines, end + 1, F.lit(1)).isin("", "\n")
            n = F.length(taken) - F.length(F.translate(taken, "\n", "")) + 1
            return F.when(fits, F.struct(end.alias("long"), n.alias("n"), known["name"].alias("name")))
        return F.array_max(F.array_compact(F.transform(start["known"], one)))
    return let(lines, match)


def _sequence(found: Column, pieces: Column) -> Column:
    """(n, sequence) of the sentences found, in order and without overlap.

    The sequence has each identifier between commas; a gap in the sentences is an extra comma.
    Pieces that are only the number of a list entry make no gap.
    """
    none = F.struct(F.lit(0).alias("next"), F.lit(0).cast("long").alias("n"), F.lit("").alias("sequence"))

    def take(state: Column, s: Column) -> Column:
        between = F.slice(pieces, state["next"] + 1, F.greatest(s["at"] - state["next"], F.lit(0)))
        others = F.exists(between, lambda x: ~x.rlike(f"^{ENTRY}$"))
        gap = F.when((state["n"] > 0) & others, ",").otherwise("")
        taken = F.struct((s["at"] + s["n"]).alias("next"), (state["n"] + 1).alias("n"),
                         F.concat(state["sequence"], gap, F.lit(","), s["name"], F.lit(",")).alias("sequence"))
        return F.when(s["at"] >= state["next"], taken).otherwise(state)
    return F.aggregate(found, none, take)


def licences(docs: DataFrame, sentences: dict[str, list[str]] | None = None,
             rules: tuple[tuple[str, tuple[str, ...]], ...] = RULES, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per document row: id, ``n_sentences`` known, their ``sequence``, ``licences``.

    Sentences of a rule must follow each other without others between; blank lines and numbers
    of list entries may stand between. At each place the first rule that fits takes its
    sentences; ``licences`` lists what was recognised in order. Known sentences that no rule
    takes only count. Null and empty texts have none. Nothing is shuffled.
    """
    sentences = sentences or SENTENCES
    # At worst a sentence has one word in each piece.
    span = max(len(f"{head} {tail}".split()) for head, tail, _ in known_sentences(sentences)) + STAR_CHARS // 2
    cut = F.filter(F.split(pieces(F.col(text_col)), "\n"), lambda x: x != "")
    rows = docs.select(F.col(id_col), cut.alias("pieces"))
    rows = rows.select(id_col, "pieces", _starts(F.col("pieces"), sentences).alias("starts"))
    sentence = F.transform("starts", lambda s: let(_sentence_at(F.col("pieces"), s, span), lambda m: F.when(
        m.isNotNull(), F.struct(s["at"].alias("at"), m["n"].alias("n"), m["name"].alias("name")))))
    rows = rows.select(id_col, "pieces", F.array_compact(sentence).alias("sentences"))
    rows = rows.select(id_col, _sequence(F.col("sentences"), F.col("pieces")).alias("found"))
    names = {"".join(f",{s}," for s in rule): licence for licence, rule in reversed(rules)
             if set(rule) <= set(sentences)}
    pattern = "|".join("".join(f",{s}," for s in rule).replace("-", r"\-") for _, rule in rules)
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    taken = F.regexp_extract_all("sequence", F.lit(f"({pattern})"), F.lit(1))
    return (rows.select(id_col, F.col("found.n").alias("n_sentences"), F.col("found.sequence").alias("sequence"))
            .select(id_col, "n_sentences", "sequence",
                    F.transform(taken, lambda s: F.element_at(lookup, s)).alias("licences")))
