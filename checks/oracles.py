"""DuckDB statements with the expected result of every query, written independently:
windows and one join per pass instead of the reduced, stacked plans."""

from __future__ import annotations

from .fixture import COUNTRIES, DUCK_REGISTER, FILES, LOADED, RELEASE, SECRET, WAVE_1, WAVE_2
from .fixture import BACKBONE, DEDUPE, PASSES_2, PASSES_8
from .queries import CODE_GROUPS

SUFFIX = r"(^|[^\p{L}\p{N}_])(?:b\.?v\.?|n\.?v\.?|v\.?o\.?f\.?)(?:\s+(?:b\.?v\.?|n\.?v\.?|v\.?o\.?f\.?))*(\s|$)"
NAME, CITY, ADDRESS = "uni_establishment_name", "uni_establishment_city", "address_key"


def uni(c):
    folded = f"strip_accents(translate(lower({c}), 'øłđħŧıς', 'oldhtiσ'))"
    for letter, plain in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th")):
        folded = f"replace({folded}, '{letter}', '{plain}')"
    return (f"coalesce(regexp_replace(regexp_replace({folded}, '{SUFFIX}', ' ', 'g'), "
            f"'[^\\p{{L}}\\p{{N}}_]', '', 'g'), '')")


def text(c):
    return f"coalesce(trim(CAST({c} AS VARCHAR)), '')"


def sized(e):
    return f"CAST(length({e}) AS VARCHAR) || ':' || {e}"


KEY = SECRET.encode().ljust(64, b"\0")
INNER, OUTER = (f"from_hex('{bytes(b ^ pad for b in KEY).hex()}')" for pad in (0x36, 0x5C))


def made(namespace, *parts):
    """HMAC-SHA256, written out."""
    joined = ", ".join(sized(p) for p in parts)
    inner = f"from_hex(sha256({INNER} || encode(concat_ws('|', '{namespace}', {joined}))))"
    return (f"regexp_replace(substr(sha256({OUTER} || {inner}), 1, 32), "
            r"'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5')")


def filled(*cols):
    return " AND ".join(f"coalesce(trim(CAST({c} AS VARCHAR)), '') <> ''" for c in cols)


def new_id(namespace, *cols, allow_blank=False):
    value = made(namespace, *[text(c) for c in cols])
    return value if allow_blank else f"CASE WHEN {filled(*cols)} THEN {value} END"


def date(c):
    return f"CAST(try_strptime({c}, '%Y%m%d') AS DATE)"


def parts(c, stem):
    return (f"CAST(year({c}) AS INTEGER) AS year_{stem}, CAST(month({c}) AS INTEGER) AS month_{stem}, "
            f"CAST(day({c}) AS INTEGER) AS day_{stem}")


ISO3 = "CASE WHEN correspondence_code_country IS NOT NULL THEN CASE correspondence_code_country " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in COUNTRIES.items()) + " ELSE 'UDF' END END"

CLEAN = f"""
f AS ({DUCK_REGISTER}),
c0 AS (SELECT row_key, nullif(trim(case_id), '') AS case_id, nullif(trim(establishment_id), '') AS establishment_id,
  hq_indicator, trim(establishment_name) AS establishment_name, trim(establishment_street) AS establishment_street,
  trim(establishment_number) AS establishment_number, trim(establishment_city) AS establishment_city,
  regexp_extract(establishment_postcode, '[0-9]+') AS establishment_pc4, code_sbi_1, code_legal_form,
  {ISO3} AS correspondence_code_iso3c, {date('date_founded')} AS date_founded,
  {date('date_registration')} AS date_registration,
  CASE indication_import WHEN 'J' THEN true WHEN 'N' THEN false END AS indication_import,
  nullif(CAST(employees_total AS INTEGER), 0) AS employees_total,
  {uni('establishment_name')} AS uni_establishment_name, {uni('establishment_street')} AS s_,
  {uni('establishment_number')} AS n_, {uni('establishment_city')} AS uni_establishment_city, wave_date,
  CASE WHEN wave_date = DATE '{WAVE_1}' THEN '{FILES[WAVE_1]}' ELSE '{FILES[WAVE_2]}' END AS file_id,
  CASE WHEN wave_date = DATE '{WAVE_1}' THEN DATE '{LOADED[WAVE_1]}' ELSE DATE '{LOADED[WAVE_2]}' END AS loaded_on
 FROM f),
c AS (SELECT *, CASE WHEN s_ <> '' OR n_ <> '' OR uni_establishment_city <> ''
   THEN s_ || '|' || n_ || '|' || uni_establishment_city END AS address_key,
  greatest(date_founded, date_registration) AS latest_event_date,
  {parts('date_founded', 'founded')}, {parts('date_registration', 'registration')},
  {made('row', 'file_id', "'=' || CAST(row_key AS VARCHAR)")} AS row_id, 'register' AS source FROM c0),
g0 AS (SELECT *, {new_id('group', 'case_id')} AS group_id, {new_id('site', 'establishment_id')} AS s0,
  {new_id('entity', 'case_id', 'establishment_id')} AS e0 FROM c),
g AS (SELECT * EXCLUDE (s0, e0),
  coalesce(s0, {new_id('site-location', 'case_id', ADDRESS, 'code_sbi_1')}) AS site_id,
  coalesce(e0, {new_id('entity-location', 'case_id', ADDRESS, 'code_sbi_1')}) AS entity_id FROM g0),
w2 AS (SELECT * FROM c WHERE wave_date = DATE '{WAVE_2}'),
first_wave AS (SELECT *, row_number() OVER (PARTITION BY coalesce(group_id, ''), coalesce(site_id, '')
   ORDER BY wave_date DESC NULLS LAST, latest_event_date DESC NULLS LAST, row_id) AS rn
  FROM g WHERE wave_date = DATE '{WAVE_1}'),
checked AS (SELECT * EXCLUDE (rn), CASE WHEN rn > 1 THEN DATE '{LOADED[WAVE_1]}' END AS superseded_on,
  coalesce(regexp_matches(case_id, '^[0-9]+$'), false) AS is_valid FROM first_wave),
bb AS (SELECT * EXCLUDE (is_valid) FROM checked WHERE is_valid)"""

# Rows with ids of their own, for the operators that hand ids on.
OWN = f"""{CLEAN},
own AS (SELECT *, {new_id('entity_id-row', 'row_id')} AS entity_id, {new_id('site_id-row', 'row_id')} AS site_id,
  {new_id('group', 'case_id')} AS group_id, CAST(NULL AS DATE) AS superseded_on FROM c)"""


def q(ctes, body):
    return f"WITH {ctes} {body}"


NEWEST = ("(superseded_on IS NOT NULL), latest_event_date DESC NULLS LAST, wave_date DESC NULLS LAST, row_id")


def one_pass(name, p, src, bb="bb"):
    """Best candidate per key by a window, joined to the source. Two CTEs."""
    order = ", ".join([f"{c} NULLS FIRST" for c in p.prefer] + [NEWEST])
    part = ", ".join(text(b) for b in p.backbone_columns)
    where = [filled("entity_id")] + ([] if p.allow_blank else [filled(*p.backbone_columns)])
    where += ["superseded_on IS NULL"] if p.active else []
    on = " AND ".join(f"{text('s.' + a)} = {text('b.' + b)}" for a, b in p.keys)
    filter_src = "TRUE" if p.allow_blank else filled(*["s." + a for a in p.source_columns])
    return f"""
{name}_b AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS rn,
   (min(entity_id) OVER (PARTITION BY {part}) <> max(entity_id) OVER (PARTITION BY {part})) AS several
  FROM {bb} WHERE {' AND '.join(where)}),
{name} AS (SELECT s.row_id, b.entity_id, b.group_id, b.site_id, {'b.several' if p.unique else 'false'} AS ambiguous,
   b.superseded_on, b.latest_event_date, b.wave_date, b.row_id AS bb_row
  FROM {src} s JOIN {name}_b b ON b.rn = 1 AND {on} WHERE {filter_src})"""


def cascade_ctes(passes, src="w2"):
    ctes = "".join("," + one_pass(f"p{i + 1}", p, src) for i, p in enumerate(passes))
    stacked = " UNION ALL ".join(f"SELECT {i + 1} AS pass, * FROM p{i + 1}" for i in range(len(passes)))
    return f"""{ctes}, hits AS ({stacked}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY pass) AS r FROM hits
  WHERE NOT ambiguous) WHERE r = 1),
doubt AS (SELECT DISTINCT row_id FROM hits WHERE ambiguous)"""


def cascade(passes):
    return q(CLEAN + cascade_ctes(passes), """
SELECT s.row_id, b.entity_id, b.group_id, b.site_id, CAST(b.pass AS INTEGER) AS match_pass,
 CASE WHEN b.row_id IS NOT NULL THEN 'linked' WHEN d.row_id IS NOT NULL THEN 'ambiguous' ELSE 'unmatched' END AS match_status
FROM w2 s LEFT JOIN best b ON s.row_id = b.row_id LEFT JOIN doubt d ON s.row_id = d.row_id""")


def exact(p, src="w2", ctes=CLEAN, own="NULL"):
    ids = ", ".join(f"CASE WHEN p.row_id IS NOT NULL AND NOT p.ambiguous THEN p.{i} ELSE "
                    f"{'s.' + i if own != 'NULL' else 'NULL'} END AS {i}" for i in ("entity_id", "group_id", "site_id"))
    kept = "WHEN s.entity_id IS NOT NULL THEN 'kept' " if own != "NULL" else ""
    return q(ctes + "," + one_pass("p1", p, src), f"""
SELECT s.row_id, {ids}, CASE WHEN p.row_id IS NOT NULL AND NOT p.ambiguous THEN 'linked' {kept}
 WHEN p.ambiguous THEN 'ambiguous' ELSE 'unmatched' END AS match_status
FROM {src} s LEFT JOIN p1 p ON s.row_id = p.row_id""")


def _threshold():
    """By pairs and agreement counts, unlike the query."""
    keys = (ADDRESS, "code_sbi_1", NAME)
    agree = " + ".join(f"CASE WHEN s.{k} = b.{k} AND {filled('s.' + k)} THEN 1 ELSE 0 END" for k in keys)
    pairs = " UNION ".join(f"SELECT s.row_id, b.row_id AS bb_row FROM w2 s JOIN bb b ON "
                           f"s.{x} = b.{x} AND s.{y} = b.{y} WHERE {filled('s.' + x, 's.' + y)}"
                           for x, y in ((keys[0], keys[1]), (keys[0], keys[2]), (keys[1], keys[2])))
    return q(f"""{CLEAN}, pairs AS ({pairs}),
scored AS (SELECT s.row_id, b.entity_id, b.group_id, b.site_id, {agree} AS agreeing,
  b.superseded_on, b.latest_event_date, b.wave_date, b.row_id AS bb_row
 FROM pairs p JOIN w2 s ON p.row_id = s.row_id JOIN bb b ON p.bb_row = b.row_id WHERE {filled('b.entity_id')}),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY agreeing DESC,
  (superseded_on IS NOT NULL), latest_event_date DESC NULLS LAST, wave_date DESC NULLS LAST, bb_row) AS r FROM scored)
 WHERE r = 1)""", """SELECT s.row_id, t.entity_id, t.group_id, t.site_id, CAST(t.agreeing AS INTEGER) AS agreeing,
 CASE WHEN t.row_id IS NULL THEN 'unmatched' ELSE 'linked' END AS match_status
FROM w2 s LEFT JOIN top t ON s.row_id = t.row_id""")


def oldest(name, cols, id_col, allow_blank):
    where = filled(id_col) + ("" if allow_blank else " AND " + filled(*cols))
    by = ", ".join(text(c) for c in cols)
    alias = ", ".join(f"{text(c)} AS k{i}" for i, c in enumerate(cols))
    return (f"{name} AS (SELECT * FROM (SELECT {alias}, {id_col} AS known, row_number() OVER (PARTITION BY {by} "
            f"ORDER BY wave_date NULLS LAST, row_id) AS rn FROM bb WHERE {where}) WHERE rn = 1)")


LOCATION = ("case_id", ADDRESS, "code_sbi_1")
CROSSWALK = (("kg", ("case_id",), "group_id", False), ("ks", ("establishment_id",), "site_id", False),
             ("ke", ("case_id", "establishment_id"), "entity_id", False),
             ("kle", LOCATION, "entity_id", True), ("kls", LOCATION, "site_id", True))


def identified(passes, src="w2"):
    """CTEs ending in `named`: the wave with ids from passes, crosswalk and new ones."""
    ctes = cascade_ctes(passes, src) if passes else (
        ", best AS (SELECT CAST(NULL AS VARCHAR) AS row_id, CAST(NULL AS VARCHAR) AS entity_id, "
        "CAST(NULL AS VARCHAR) AS group_id, CAST(NULL AS VARCHAR) AS site_id, NULL AS pass WHERE false)")
    ctes += "".join(", " + oldest(*x) for x in CROSSWALK)
    joins = "".join(
        f" LEFT JOIN {n} ON " + " AND ".join(f"{n}.k{i} = {text('s.' + c)}" for i, c in enumerate(cols))
        + ("" if blank else " AND " + filled(*["s." + c for c in cols]))
        for n, cols, _, blank in CROSSWALK)
    s = lambda *cols: ["s." + c for c in cols]
    return ctes + f""", named AS (SELECT s.*, b.pass,
  coalesce(b.group_id, kg.known, {new_id('group', *s('case_id'))}) AS group_id,
  coalesce(b.site_id, ks.known, {new_id('site', *s('establishment_id'))}, kls.known,
           {new_id('site-location', *s(*LOCATION), allow_blank=True)}) AS site_id,
  coalesce(b.entity_id, ke.known, {new_id('entity', *s('case_id', 'establishment_id'))}, kle.known,
           {new_id('entity-location', *s(*LOCATION), allow_blank=True)}) AS entity_id
 FROM {src} s LEFT JOIN best b ON s.row_id = b.row_id{joins})"""


def _update(state="bb"):
    """CTEs ending in `hist`, and the new validity and superseding date: the second wave on top of
    `state`, by one window over everything."""
    cols = ", ".join(BACKBONE)
    own = ", ".join(c if c != "superseded_on" else "CAST(NULL AS DATE) AS superseded_on" for c in BACKBONE)
    same = " AND ".join(f"k.{c} IS NOT DISTINCT FROM once.{c}" for c in DEDUPE)
    valid = "newest_superseded IS NULL AND coalesce(regexp_matches(case_id, '^[0-9]+$'), false)"
    marked = f"CASE WHEN rn > 1 AND superseded_on IS NULL THEN DATE '{LOADED[WAVE_2]}' ELSE superseded_on END"
    return f"""{CLEAN}{identified(PASSES_2)},
once AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(DEDUPE)}
  ORDER BY wave_date NULLS LAST, loaded_on NULLS LAST, row_id) AS rn FROM (SELECT {own} FROM named)) WHERE rn = 1),
dd AS (SELECT * FROM once WHERE NOT EXISTS (SELECT 1 FROM {state} k WHERE k.superseded_on IS NULL AND {same})
  UNION ALL SELECT {cols} FROM {state}),
hist AS (SELECT *, row_number() OVER w AS rn, first_value(superseded_on) OVER w AS newest_superseded FROM dd
  WINDOW w AS (PARTITION BY coalesce(group_id, ''), coalesce(site_id, '')
   ORDER BY wave_date DESC NULLS LAST, latest_event_date DESC NULLS LAST, row_id)),
after AS (SELECT * EXCLUDE (rn, newest_superseded, superseded_on), ({valid}) AS is_valid, {marked} AS superseded_on FROM hist)"""


HISTORY = f"""{CLEAN},
hist AS (SELECT *, row_number() OVER (PARTITION BY coalesce(group_id, ''), coalesce(site_id, '')
  ORDER BY wave_date DESC NULLS LAST, latest_event_date DESC NULLS LAST, row_id) AS rn FROM g)"""
SUPERSEDED = f"CASE WHEN rn > 1 THEN DATE '{LOADED[WAVE_2]}' END AS superseded_on"
NUMERIC = "coalesce(regexp_matches(case_id, '^[0-9]+$'), false)"

KEYED = filled("case_id", "establishment_id")
SITE_W = "PARTITION BY case_id, establishment_id ORDER BY wave_date, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
F2 = FILES[WAVE_2]
AS_OF = f"DATE '{LOADED[WAVE_2]}'"


def first_of(c, where="TRUE"):
    return f"first_value(CASE WHEN {where} THEN {c} END IGNORE NULLS) OVER ({SITE_W})"


NONBLANK = "nullif(trim({}), '')"


def _k_of_n(with_file):
    older = f"file_id <> '{F2}'" if with_file else "TRUE"
    ev = (ADDRESS, "code_sbi_1", NAME)
    firsts = ", ".join(f"{first_of(NONBLANK.format(c), older)} AS f{i}" for i, c in enumerate(ev))
    score = " + ".join(f"CASE WHEN trim({c}) = f{i} THEN 1 ELSE 0 END" for i, c in enumerate(ev))
    taker = f"agrees AND file_id = '{F2}'" if with_file else "agrees"
    stamp = (f"CASE WHEN {KEYED} AND {older} AND n_current > 0 THEN {AS_OF} END" if with_file else "CAST(NULL AS DATE)")
    return q(f"""{OWN}, a AS (SELECT *, {firsts},
  count(*) FILTER (file_id = '{F2}') OVER (PARTITION BY case_id, establishment_id) AS n_current FROM own),
b AS (SELECT *, ({KEYED} AND ({score}) >= 2) AS agrees FROM a),
d AS (SELECT *, {first_of('entity_id', f'agrees AND {older}')} AS oe, {first_of('site_id', f'agrees AND {older}')} AS os FROM b)""",
             f"""SELECT row_id, CASE WHEN {taker} THEN coalesce(oe, entity_id) ELSE entity_id END AS entity_id,
 CASE WHEN {taker} THEN coalesce(os, site_id) ELSE site_id END AS site_id, {stamp} AS superseded_on FROM d""")


def _renumber(allow_blank):
    by = ", ".join(text(c) for c in LOCATION)
    part = by if allow_blank else f"CASE WHEN {filled(*LOCATION)} THEN concat_ws('~', {by}) ELSE row_id END"
    w = f"PARTITION BY {part} ORDER BY wave_date, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    return q(OWN, f"""SELECT row_id, first_value(entity_id) OVER w AS entity_id,
 coalesce(first_value(group_id) OVER w, group_id) AS group_id, first_value(site_id) OVER w AS site_id,
 CASE WHEN row_id <> last_value(row_id) OVER w THEN {AS_OF} END AS superseded_on FROM own WINDOW w AS ({w})""")


def _numeric(table, cols):
    out = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        # Population skewness from central moments.
        out.append(f"""SELECT '{c}' AS "column", round(avg({x}), 3) AS mean, round(median({x}), 3) AS median,
  round(stddev_samp({x}), 3) AS stddev,
  round((SELECT avg(pow({x} - m, 3)) / pow(avg(pow({x} - m, 2)), 1.5) FROM {table}, (SELECT avg({x}) AS m FROM {table})), 3) AS skewness,
  count(*) - count({c}) AS null_count FROM {table}""")
    return out


def _strings(table, cols):
    return [f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_count, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM {table}"
            for c in cols]


def _stats(numeric, strings, other, types, order, table):
    rows = [f"SELECT \"column\", mean, median, stddev, skewness, CAST(NULL AS BIGINT) AS distinct_count, null_count FROM ({s})"
            for s in numeric]
    rows += [f"SELECT \"column\", NULL, NULL, NULL, NULL, distinct_count, null_count FROM ({s})" for s in strings]
    rows += [f"SELECT '{c}', NULL, NULL, NULL, NULL, NULL, count(*) - count({c}) FROM {table}" for c in other]
    type_of = "CASE \"column\" " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in types.items()) + " END"
    place = "CASE \"column\" " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(order)) + " END"
    return (f"SELECT \"column\", {type_of} AS type, CAST({place} AS INTEGER) AS position, mean, median, stddev, skewness, "
            f"distinct_count, null_count FROM ({' UNION ALL '.join(rows)})")


def _histogram(cols):
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", bin, count(*) AS rows FROM (
 SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(7, floor((CAST({c} AS DOUBLE) - lo) / ((hi - lo) / 8))) END AS INTEGER) AS bin
 FROM lineitem, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM lineitem)) GROUP BY bin""" for c in cols)


LABELS = """(VALUES ('l_returnflag','A','accepted'), ('l_returnflag','R','returned'), ('l_returnflag','X','never used'),
 ('l_linestatus','O','open')) AS l(col, val, label)"""
MEMBERS = "(VALUES " + ", ".join(f"('{g}','{c}')" for g, cs in CODE_GROUPS.items() for c in cs) + ") AS m(release_group, code)"
SUBSETS = f"""sub AS (SELECT c.*, 'complete' AS release_group FROM c UNION ALL
 SELECT c.*, m.release_group FROM c JOIN {MEMBERS} ON c.code_legal_form = m.code)"""
IDS = "row_id, entity_id, group_id, site_id"


def _by(*names, **options):
    from longreg.operators.link import MatchPass
    return MatchPass.on(*names, **options)


def oracle_sql() -> dict[str, str]:
    raw = f"f AS ({DUCK_REGISTER})"
    known = lambda blank: q(f"{CLEAN}, {oldest('k', LOCATION, 'entity_id', blank)}",
        f"""SELECT s.row_id, coalesce(k.known, {new_id('entity-location', *['s.' + c for c in LOCATION], allow_blank=blank)}) AS entity_id
 FROM w2 s LEFT JOIN k ON """ + " AND ".join(f"k.k{i} = {text('s.' + c)}" for i, c in enumerate(LOCATION))
        + ("" if blank else " AND " + filled(*["s." + c for c in LOCATION])))
    row_date = lambda f: q(raw, f"SELECT row_key, {f}({date('date_founded')}, {date('date_registration')}) AS event_date FROM f")
    trims = lambda e: q(raw, "SELECT row_key, " + ", ".join(f"{e(c)} AS {c}" for c in (
        "case_id", "establishment_id", "establishment_name", "hq_indicator")) + " FROM f")
    release_types = ", ".join(c for c in RELEASE if c != "superseded_on")
    own_entities = f"e2 AS (SELECT g.*, CAST(NULL AS DATE) AS superseded_on FROM g WHERE wave_date = DATE '{WAVE_2}')"
    lineitem = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    texts = ["case_id", "hq_indicator", "establishment_name", "establishment_city", "correspondence_code_country"]
    flags = {"l_returnflag": "string", "l_linestatus": "string", "l_quantity": "double"}
    mixed = {"employees_total": "int", "hq_indicator": "string", "date_founded": "date", "indication_import": "boolean"}
    return {
        "scan_csv_roundtrip": q(raw, "SELECT " + ", ".join(
            f"nullif(trim(CAST({c} AS VARCHAR)), '') AS {c}" for c in (
                "row_key", "case_id", "establishment_id", "hq_indicator", "establishment_name", "establishment_street",
                "establishment_number", "establishment_city", "establishment_postcode", "code_sbi_1", "code_legal_form",
                "correspondence_code_country", "date_founded", "date_registration", "indication_import",
                "employees_total", "wave_date")) + " FROM f"),
        "bronze_manifest": q(CLEAN, "SELECT source, wave_date, file_id, count(*) AS rows FROM c GROUP BY ALL"),
        "bronze_roundtrip": q(raw, f"""SELECT CAST(row_key AS VARCHAR) AS row_key, case_id, hq_indicator, code_sbi_1,
 CASE wave_date WHEN DATE '{WAVE_1}' THEN 'row_key,case_id,source,code_sbi_1' ELSE 'row_key,case_id,file_id,wave_date' END AS header,
 count(*) OVER (PARTITION BY wave_date) AS rows FROM f"""),
        "split_matched_counts": f"SELECT matched, count(*) AS rows FROM (SELECT entity_id IS NOT NULL AS matched FROM ("
                                + exact(_by(NAME, CITY, unique=True)) + ")) GROUP BY matched",
        "dictionary_labels": "SELECT 'part_' || p_partkey AS \"column\", p_brand AS description, CAST(p_size AS VARCHAR) AS value, p_type AS label FROM part",
        "dictionary_study": "SELECT p_name AS title, CAST(p_partkey AS VARCHAR) AS id FROM part",
        "rename_map": "SELECT c_custkey AS case_number, c_name AS company_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "drop_by_pattern": "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
        "ensure_columns": "SELECT *, CAST(NULL AS VARCHAR) AS case_id FROM customer",
        "order_columns": "SELECT p_size, p_brand, p_name, p_partkey, p_retailprice, p_type FROM part",
        "select_required": "SELECT o_orderkey, o_orderstatus FROM orders",
        "add_lineage": q(CLEAN, """SELECT CAST(NULL AS VARCHAR) AS entity_id, CAST(NULL AS VARCHAR) AS group_id, CAST(NULL AS VARCHAR) AS site_id,
 row_id, file_id, wave_date, loaded_on, CAST(NULL AS DATE) AS superseded_on, latest_event_date, source, address_key FROM w2"""),
        "standardise_wave": q(CLEAN, "SELECT " + ", ".join(c for c in BACKBONE if c not in (
            "entity_id", "group_id", "site_id", "superseded_on")) + " FROM w2"),
        "release_projection": q(CLEAN, f"SELECT {release_types}, CAST(NULL AS DATE) AS superseded_on FROM g"),
        "filter_not_blank": q(CLEAN, "SELECT row_key, case_id, establishment_id, date_founded FROM c WHERE case_id IS NOT NULL AND establishment_id IS NOT NULL AND date_founded IS NOT NULL"),
        "history_active": q(CLEAN, f"SELECT {IDS} FROM bb WHERE superseded_on IS NULL"),
        "release_subsets": q(f"{CLEAN}, {SUBSETS}", "SELECT release_group, count(*) AS rows FROM sub GROUP BY 1"),
        "release_subset_rows": q(f"{CLEAN}, {SUBSETS}", "SELECT row_key, code_legal_form, release_group FROM sub"),
        "fill_nulls": q(raw, "SELECT row_key, coalesce(hq_indicator, '?') AS hq_indicator, coalesce(correspondence_code_country, '?') AS correspondence_code_country FROM f"),
        "null_if": q(raw, "SELECT row_key, nullif(date_founded, '0') AS date_founded, nullif(establishment_number, '0') AS establishment_number FROM f"),
        "exact_match_basic": exact(_by("case_id", "establishment_id")),
        "exact_match_allow_blank": exact(_by("case_id", "establishment_id", NAME, allow_blank=True)),
        "exact_match_prefer_hq": exact(_by(NAME, prefer=("hq_indicator",))),
        "exact_match_unique": exact(_by(NAME, CITY, unique=True)),
        "exact_match_active": exact(_by(NAME, "date_founded", active=True)),
        "exact_match_override": exact(_by(NAME, CITY, override=True), "e2", f"{CLEAN}, {own_entities}", "own"),
        "exact_match_mapped": exact(_by("case_id", "establishment_id")),
        "match_cascade_2": cascade(PASSES_2),
        "match_cascade_8": cascade(PASSES_8),
        "threshold_match": _threshold(),
        "release_restrict": q(f"{CLEAN}, {own_entities}", f"""SELECT row_id, entity_id FROM e2 WHERE entity_id IN (SELECT entity_id FROM bb
 WHERE superseded_on IS NULL AND code_legal_form IN {CODE_GROUPS['legal_profit']})"""),
        "release_by_backbone": q(f"{CLEAN}, {own_entities}", f"""SELECT row_id, 'complete' AS release_group FROM e2 UNION ALL
 SELECT DISTINCT e2.row_id, m.release_group FROM e2 JOIN bb ON e2.entity_id = bb.entity_id AND bb.superseded_on IS NULL
 JOIN {MEMBERS} ON bb.code_legal_form = m.code"""),
        "refresh_by_row_id": q(OWN, "SELECT o.row_id, bb.entity_id, o.group_id, bb.superseded_on FROM own o LEFT JOIN bb ON o.row_id = bb.row_id"),
        "map_codes": q(raw, f"SELECT row_key, correspondence_code_country, {ISO3} AS iso3 FROM f"),
        "map_codes_table": q(raw, """SELECT row_key, correspondence_code_country, CASE WHEN correspondence_code_country IS NOT NULL
 THEN coalesce(n_name, 'UDF') END AS country FROM f LEFT JOIN nation ON lpad(CAST(n_nationkey AS VARCHAR), 4, '0') = correspondence_code_country"""),
        "dictionary_coverage": q("""described AS (SELECT "column", 'seen ' || count(*) AS description FROM (
  SELECT unnest(['o_orderkey', 'o_custkey', 'flag_' || l_returnflag]) AS "column" FROM lineitem) GROUP BY "column"),
filled AS (UNPIVOT (SELECT count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey, count(o_orderstatus) AS o_orderstatus,
  count(o_totalprice) AS o_totalprice, count(o_orderdate) AS o_orderdate, count(o_orderpriority) AS o_orderpriority FROM orders)
 ON COLUMNS(*) INTO NAME "column" VALUE filled)""", """SELECT coalesce(f."column", d."column") AS "column", description, filled,
 CASE WHEN f."column" IS NULL THEN 'orphan' WHEN d."column" IS NULL THEN 'undocumented' ELSE 'documented' END AS coverage
FROM filled f FULL JOIN described d ON d."column" = f."column" """),
        "profile_numeric": " UNION ALL ".join(_numeric("lineitem", lineitem)),
        "profile_string": q(raw, " UNION ALL ".join(_strings("f", texts))),
        "profile_nulls": q(CLEAN, """SELECT 'date_founded' AS "column", count(*) - count(date_founded) AS null_count FROM c UNION ALL
 SELECT 'indication_import', count(*) - count(indication_import) FROM c UNION ALL SELECT 'site_id', count(*) FROM c"""),
        "profile_columns": q(CLEAN, _stats(_numeric("c", ["employees_total"]), _strings("c", ["hq_indicator"]),
                                           ["date_founded", "indication_import"], mixed, list(mixed), "c")),
        "dataset_dims": "SELECT 'orders' AS dataset, count(*) AS rows, CAST(6 AS BIGINT) AS columns FROM orders",
        "histogram": _histogram(["l_quantity", "l_extendedprice", "l_linenumber"]),
        "label_frequency": f"""SELECT coalesce(x.col, l.col) AS "column", coalesce(x.val, l.val) AS value, label, coalesce(n, 0) AS rows FROM (
 SELECT 'l_returnflag' AS col, l_returnflag AS val, count(*) AS n FROM lineitem GROUP BY ALL UNION ALL
 SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY ALL) x FULL JOIN {LABELS} ON x.col = l.col AND x.val = l.val""",
        "codebook": f"""SELECT position, "column" AS name, CASE "column" WHEN 'l_quantity' THEN 'No description provided' ELSE upper("column") END AS label,
 type, CAST(CASE "column" WHEN 'l_returnflag' THEN 3 WHEN 'l_linestatus' THEN 1 END AS INTEGER) AS labels, mean, median, stddev, skewness,
 distinct_count, null_count FROM ({_stats(_numeric('lineitem', ['l_quantity']), _strings('lineitem', ['l_returnflag', 'l_linestatus']), [], flags, list(flags), 'lineitem')})""",
        "top1_per_key": """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
 ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r = 1""",
        "history_supersede": q(HISTORY, f"SELECT row_id, group_id, site_id, {SUPERSEDED} FROM hist"),
        "inherit_oldest_id": q(OWN, f"""SELECT row_id, CASE WHEN {KEYED} THEN {first_of('entity_id')} ELSE entity_id END AS entity_id,
 CASE WHEN {KEYED} THEN {first_of('site_id')} ELSE site_id END AS site_id FROM own"""),
        "inherit_id_from_older_file": q(f"""{OWN}, a AS (SELECT *, {first_of('entity_id', f"file_id <> '{F2}'")} AS oe,
  {first_of('site_id', f"file_id <> '{F2}'")} AS os,
  count(*) FILTER (file_id = '{F2}') OVER (PARTITION BY case_id, establishment_id) AS n_current FROM own)""",
            f"""SELECT row_id, CASE WHEN {KEYED} AND file_id = '{F2}' THEN coalesce(oe, entity_id) ELSE entity_id END AS entity_id,
 CASE WHEN {KEYED} AND file_id = '{F2}' THEN coalesce(os, site_id) ELSE site_id END AS site_id,
 CASE WHEN {KEYED} AND file_id <> '{F2}' AND n_current > 0 THEN {AS_OF} END AS superseded_on FROM a"""),
        "inherit_id_k_of_n": _k_of_n(False),
        "inherit_id_k_of_n_file": _k_of_n(True),
        "backbone_union": q(f"{CLEAN}, {own_entities}", f"SELECT {', '.join(BACKBONE)} FROM e2 UNION ALL SELECT {', '.join(BACKBONE)} FROM bb"),
        "drop_duplicates": """SELECT * EXCLUDE (r) FROM (SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate), row_number() OVER (
 PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
 l_returnflag, l_linestatus, l_shipdate) AS r FROM lineitem) WHERE r = 1""",
        "drop_duplicates_register": q(CLEAN, f"""SELECT row_id, {', '.join(DEDUPE)} FROM (SELECT *, row_number() OVER (
 PARTITION BY {', '.join(DEDUPE)} ORDER BY wave_date, loaded_on, row_id) AS r FROM c) WHERE r = 1"""),
        "duplicate_groups": q(OWN, f"""SELECT {', '.join(text(c) + ' AS ' + c for c in LOCATION)}, count(*) AS duplicate_count,
 last(row_id ORDER BY wave_date, row_id) AS latest_row_id, first(entity_id ORDER BY wave_date, row_id) AS entity_id,
 first(group_id ORDER BY wave_date, row_id) AS group_id, first(site_id ORDER BY wave_date, row_id) AS site_id
FROM own WHERE {filled(*LOCATION)} GROUP BY {', '.join(text(c) for c in LOCATION)} HAVING count(*) > 1"""),
        "renumber_duplicates": _renumber(False),
        "renumber_duplicates_blank": _renumber(True),
        "normalize_text": q(raw, f"SELECT row_key, establishment_name, establishment_city, {uni('establishment_name')} AS uni_establishment_name, {uni('establishment_city')} AS uni_establishment_city FROM f"),
        "normalize_documents": f"SELECT doc_id, {uni('text')} AS uni_text FROM documents",
        "trim_columns": trims(lambda c: f"nullif(trim({c}), '')"),
        "trim_columns_empty": trims(lambda c: f"coalesce(trim({c}), '')"),
        "parse_dates": q(raw, f"""SELECT row_key, date_founded, date_registration, {parts('date_founded', 'founded')}, {parts('date_registration', 'registration')}
 FROM (SELECT row_key, {date('date_founded')} AS date_founded, {date('date_registration')} AS date_registration FROM f)"""),
        "decode_boolean": q(raw, "SELECT row_key, CASE indication_import WHEN 'J' THEN true WHEN 'N' THEN false END AS indication_import FROM f"),
        "decode_boolean_true_only": q(raw, "SELECT row_key, coalesce(indication_import = 'J', false) AS indication_import FROM f"),
        "cast_int": q(raw, "SELECT row_key, " + ", ".join(f"TRY_CAST({c} AS INTEGER) AS {c}" for c in (
            "employees_total", "establishment_id", "indication_import")) + " FROM f"),
        "extract_digits": q(raw, "SELECT row_key, establishment_postcode, establishment_street, regexp_extract(establishment_postcode, '[0-9]+') AS pc4, regexp_extract(establishment_street, '[0-9]+') AS street_digits FROM f"),
        "row_latest_date": row_date("greatest"),
        "row_earliest_date": row_date("least"),
        "address_key": q(CLEAN, "SELECT row_key, address_key FROM c"),
        "pad_ids": """SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS case_id,
 CASE WHEN c_nationkey = 0 THEN NULL WHEN length(c_name) < 12 THEN lpad(c_name, 12, '0') ELSE c_name END AS establishment_id FROM customer""",
        "quality_checks": q(raw, f"""SELECT rule, "column", rows, blank, failed FROM (
 SELECT 'file id is a random uuid' AS rule, 'file_id' AS "column", count(*) AS rows, 0::BIGINT AS blank, 0::BIGINT AS failed FROM f UNION ALL
 SELECT 'firm number has 8 digits', 'case_id', count(*), count(*) FILTER (coalesce(trim(case_id), '') = ''),
  count(*) FILTER (trim(case_id) <> '' AND NOT regexp_matches(case_id, '^[0-9]{{8}}$')) FROM f UNION ALL
 SELECT 'founding date is a date', 'date_founded', count(*), count(*) FILTER (coalesce(trim(date_founded), '') = ''),
  count(*) FILTER (trim(date_founded) <> '' AND {date('date_founded')} IS NULL) FROM f UNION ALL
 SELECT 'head count is an integer', 'employees_total', count(*), count(*) FILTER (coalesce(trim(employees_total), '') = ''),
  count(*) FILTER (trim(employees_total) <> '' AND TRY_CAST(employees_total AS INTEGER) IS NULL) FROM f UNION ALL
 SELECT 'country is an iso date', 'correspondence_code_country', count(*), count(*) FILTER (correspondence_code_country IS NULL),
  count(*) FILTER (correspondence_code_country IS NOT NULL) FROM f)"""),
        "assign_ids_new": q(CLEAN, f"SELECT row_id, {new_id('site-location', 'case_id', ADDRESS)} AS site_id FROM w2"),
        "assign_ids_known": known(False),
        "assign_ids_known_blank": known(True),
        "generate_ids": q(CLEAN, f"SELECT {IDS} FROM g"),
        "append_ids": q(CLEAN + identified([]), f"SELECT {IDS} FROM named"),
        "backbone_create": q(CLEAN, f"SELECT {', '.join(BACKBONE)}, is_valid FROM checked"),
        "backbone_update": q(_update(), "SELECT * FROM after"),
        "backbone_update_quarantine": q(_update("checked"), "SELECT * FROM after"),
        "backbone_changes": q(_update("checked"), """SELECT a.row_id, a.case_id, a.superseded_on, a.is_valid, k.row_id IS NULL AS is_new
 FROM after a LEFT JOIN checked k ON a.row_id = k.row_id WHERE k.row_id IS NULL OR a.superseded_on IS DISTINCT FROM k.superseded_on
  OR a.is_valid <> k.is_valid"""),
        "identified_wave": q(CLEAN + identified(PASSES_2), f"""SELECT {IDS}, CAST(pass AS INTEGER) AS match_pass,
 CASE WHEN pass IS NULL THEN 'unmatched' ELSE 'linked' END AS match_status FROM named"""),
        "history_clean": q(HISTORY, f"SELECT row_id, {SUPERSEDED} FROM hist WHERE {NUMERIC}"),
        "history_quarantine": q(HISTORY, f"SELECT row_id, case_id FROM hist WHERE NOT {NUMERIC}"),
        "invariant_single_active": q(CLEAN, "SELECT group_id, site_id, count(*) AS versions, count(*) AS active_rows FROM g GROUP BY ALL HAVING count(*) <> 1"),
        "active_per_entity": q(CLEAN, "SELECT entity_id, count(*) AS versions, count(*) FILTER (superseded_on IS NULL) AS active_rows FROM bb GROUP BY 1"),
    }
