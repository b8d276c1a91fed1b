"""Schemas of the lexical datasets. Absent values are null; order in arrays is meaning."""

from __future__ import annotations

CL = "struct<w: string, t: string, py: string>"
REF = "struct<kind: string, w: string, t: string, py: string>"
SENSE = f"struct<en: array<string>, ja: string, qa: string, unsure: boolean, misc: array<string>, variant_of: array<{REF}>, see_also: array<{REF}>, lsource: array<string>, s_inf: array<string>>"
PARSED_SENSE = f"struct<en: array<string>, misc: array<string>, variant_of: array<{REF}>, see_also: array<{REF}>, lsource: array<string>, s_inf: array<string>>"
PARSED = f"ord bigint, trad string, simp string, pinyin string, tw_pr string, also_pr string, cl array<{CL}>, senses array<{PARSED_SENSE}>"
BASE = f"id string, word string, trad string, pinyin string, tw_pr string, also_pr string, cl array<{CL}>, hsk2 int, hsk3 int, pos array<string>, src string, seed string, seed_gloss array<string>, senses array<{SENSE}>, ord bigint"
NATIVE = f"word string, trad string, pinyin string, tw_pr string, also_pr string, cl array<{CL}>, hsk2 int, hsk3 int, pos array<string>, src string, seed string, moe string, primary int, default boolean, senses array<{SENSE}>, ord bigint"
GLOSS = "id string, sense int, ja string"
LEGACY = "ord bigint, word string, pinyin string, gloss array<string>, qa string, unsure boolean, trad array<string>, hsk2 int, hsk3 int, pos array<string>"
HSK_ENTRY = "word string, pinyin string, pos string, hsk_levels struct<`2.0`: int, `3.0`: int>"
REFERENCE_ENTRY = "title string, heteronyms array<struct<definitions: array<struct<type: string>>>>"
PRIMARY_RECORD = "word string, trad string, pinyin string, sense int, ja string"
DEFAULT_RECORD = "word string, trad string, pinyin string"
POS_RECORD = "word string, trad string, pinyin string, add array<string>, reason string"
JA_ZH = "word string, zh array<struct<s: string, pinyin: string>>, unsure boolean"
EVIDENCE = "struct<subject: string, method: string, result: string, source_value: string>"
VIOLATION = "path string, line bigint, word string, kind string, detail string"

#: The name under which the dictionary's own data stand in `src`, ids and extensions.
DICTIONARY_NAME = "own-dict"
