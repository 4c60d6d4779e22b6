"""Licence scans by sentences: normalised sentences to identifiers, identifiers to licences.

A sentence stands between line ends, full stops, question and exclamation marks, semicolons and
colons, the marks followed by white space or the end; it may hold semicolons and colons, and run
over single line ends up to a mark or an empty line, as notices do. It is normalised to lower-case
words with single spaces. Known sentences map to identifiers; the others drop out, so that a
document is a short sequence of identifiers. A rule is an ordered list of identifiers and holds
where they stand in this order, other known sentences between them allowed.

The SQL knows SENTENCES and RULES only, one line and no clause ends: it agrees with the operator
on texts without wrapped or whole notices.

Defined cases: null and empty texts have no sentence and no licence; a sentence that repeats
counts each time; a document may carry several licences (sorted by name); repeated rows are
separate rows; other columns are not read. Only DataFrame operations, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import columns, documents

# Licence sentences (lower case, words only), one identifier each, and the
# ordered rules over them.
SENTENCES = {
    "licensed under the apache license version 2 0": "A1",
    "you may not use this file except in compliance with the license": "A2",
    "released under the mit license": "M1",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "M2",
    "the software is provided as is without warranty of any kind express or implied": "M3",
    "this work is licensed under the gnu general public license version 3": "G1",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "G2",
    "this program is distributed in the hope that it will be useful but without any warranty": "G3",
    "licensed under cc by nc 4 0": "C1",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "C2",
    "redistribution and use in source and binary forms with or without modification are permitted": "B1",
    "all rights reserved": "R1",
}
RULES = {
    "Apache-2.0": [["A1"], ["A1", "A2"]],
    "MIT": [["M1"], ["M2", "M3"]],
    "GPL-3.0": [["G1"], ["G2", "G3"]],
    "CC-BY-NC-4.0": [["C1"], ["C2"]],
    "BSD": [["B1"]],
    "proprietary": [["R1"]],
}
# The whole sentences of the standard notices (MIT, BSD, GPL and Apache headers), and their rules.
# A sentence that goes on after one of SENTENCES keeps its identifier.
NOTICES = {
    "licensed under the apache license version 2 0 the license": "A1",
    "you may obtain a copy of the license at": "A3",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "A4",
    "see the license for the specific language governing permissions and limitations under the license": "A5",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "M2",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "M4",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "M3",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "M5",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "B1",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "B2",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "B3",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "B4",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "B5",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "G2",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "G4",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "G3",
    "see the gnu general public license for more details": "G5",
    "you should have received a copy of the gnu general public license along with this program": "G6",
}
NOTICE_RULES = {
    "Apache-2.0": [["A2", "A3", "A4"]],
    "MIT": [["M2", "M4"], ["M4", "M3", "M5"]],
    "BSD": [["B2", "B3", "B5"]],
    "GPL-2.0": [["G4", "G3"]],
}
_KNOWN = SENTENCES | NOTICES
#: Every known sentence holds one of these words: a cheap first look at a text.
_HINT = r"(?i)licen[sc]e|permission|warrant|redistribut|rights|liable"
# Marks of a normalised text: the end of a sentence, and the end of a clause.
_END, _CLAUSE = "\x01", "\x02"


def _pattern() -> str:
    """Finds the known sentences of a normalised text, longer ones first. Clause ends may stand
    within a sentence, and single line ends if it then ends at a mark, an empty line or the
    end of the text."""
    found = []
    for s in sorted(_KNOWN, key=lambda s: (-len(s), s)):
        w = s.split(" ")
        found.append(f"(?:[ {_CLAUSE}]|{_CLAUSE}?\n)".join(w) + f"(?=\\z|[{_END}{_CLAUSE}]|\n\n)")
        found.append(f"[ {_CLAUSE}]".join(w) + "(?=\n)")
    return f"(?:\\A|(?<=[\n{_END}{_CLAUSE}]))(?:" + "|".join(found) + ")"


def _normalised(text: Column) -> Column:
    """Lower-case words with single spaces, line ends and marks between them."""
    t = F.translate(F.lower(text), _END + _CLAUSE, "  ")
    t = F.regexp_replace(t, r"[.?!]+(?=\s|$)", _END)
    t = F.regexp_replace(t, r"[;:]+(?=\s|$)", _CLAUSE)
    t = F.regexp_replace(t, f"[^a-z0-9\n{_END}{_CLAUSE}]+", " ")
    t = F.regexp_replace(t, f"[ {_CLAUSE}]*{_CLAUSE}[ {_CLAUSE}]*", _CLAUSE)
    return F.trim(F.regexp_replace(t, f" *([\n{_END}{_CLAUSE}]) *", "$1"))


def sentence_ids(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    found = F.when(text.rlike(_HINT), F.regexp_extract_all(
        _normalised(text), F.lit(_pattern()), F.lit(0)))
    known = F.create_map(*[F.lit(x) for pair in _KNOWN.items() for x in pair])
    return F.coalesce(F.transform(found, lambda s: F.element_at(
        known, F.regexp_replace(s, "[^a-z0-9]+", " "))), F.array().cast("array<string>"))


def matched(sequence: Column) -> Column:
    """The sorted names of the licences of which a rule holds; ``sequence``: ids with commas."""
    holds = []
    for name in sorted(RULES | NOTICE_RULES):
        any_rule = F.lit(False)
        for rule in RULES.get(name, []) + NOTICE_RULES.get(name, []):
            any_rule = any_rule | sequence.rlike("(^|,)" + "(,.*)?,".join(rule) + "(,|$)")
        holds.append(F.when(any_rule, F.lit(name)))
    return F.concat_ws(",", F.array_sort(F.array_compact(F.array(*holds))))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_sentences, sentence_ids, licenses) of every row."""
    ids = columns(docs, id_col, text_col).select(
        F.col(id_col).alias("doc_id"), sentence_ids(F.col(text_col)).alias("ids"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_sentences"),
                      F.concat_ws(",", "ids").alias("sentence_ids")) \
        .withColumn("licenses", matched(F.col("sentence_ids")))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def _oracle() -> str:
    known = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    rules = ", ".join(
        f"('{name}', '%,{',%,'.join(rule)},%')".replace(",%,", ",%,")
        for name, all_rules in RULES.items() for rule in all_rules)
    return f"""
WITH known(s, id) AS (VALUES {known}), rules(name, pat) AS (VALUES {rules}),
cuts AS (SELECT row_number() OVER () AS rid, doc_id,
           regexp_split_to_array(regexp_replace(coalesce(text, ''), '[.?!]+(\\s|$)', chr(10), 'g'), '\\n') AS cut
         FROM documents),
sents AS (SELECT rid, generate_subscripts(cut, 1) AS k, unnest(cut) AS s FROM cuts),
hits AS (SELECT rid, k, id FROM sents JOIN known
         ON known.s = trim(regexp_replace(lower(sents.s), '[^a-z0-9]+', ' ', 'g'))),
seqs AS (SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY k) AS ids FROM hits GROUP BY rid),
found AS (SELECT rid, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM seqs
          JOIN rules ON ',,' || replace(ids, ',', ',,') || ',,' LIKE pat GROUP BY rid)
SELECT doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids,
       coalesce(licenses, '') AS licenses
FROM cuts LEFT JOIN seqs USING (rid) LEFT JOIN found USING (rid)
"""


OP4_SQL = _oracle()
