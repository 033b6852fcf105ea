"""The SQL twins of the operators, for DuckDB: pieces of queries, composed into the oracles of the catalog."""

from __future__ import annotations

from ..functions import lexicon as L


def _list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def text(x: str) -> str:
    x = rf"lower(regexp_replace(strip_accents(coalesce({x}, '')), '[^\x00-\x7F]', '', 'g'))"
    x = f"replace(replace({x}, '&', ' and '), '@', 'a')"
    x = rf"regexp_replace({x}, '''s\b', '', 'g')"
    x = rf"regexp_replace({x}, '[^\w\s-]', ' ', 'g')"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def name(x: str) -> str:
    x = f"regexp_replace({text(x)}, '{L.TRADE_MARKERS}', '', 'g')"
    for form in L.LEGAL_FORMS:
        x = f"regexp_replace({x}, '{form}', '', 'g')"
    x = f"regexp_replace({x}, '^[ -]+|[ -]+$', '', 'g')"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def address(x: str) -> str:
    x = rf"regexp_replace({text(x)}, '\b0+(\d+)\b', '\1', 'g')"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.ADDRESS_ABBREVIATIONS.items())
    x = f"array_to_string(list_transform(string_split({x}, ' '), lambda t: CASE t {cases} ELSE t END), ' ')"
    return rf"trim(regexp_replace(regexp_replace({x}, '{L.UNIT}', '', 'g'), '\s+', ' ', 'g'))"


def tokens(x: str, stop) -> str:
    return f"list_distinct(list_filter(string_split({x}, ' '), lambda t: len(t) > 1 AND t NOT IN {_list(stop)}))"


def name_tokens(x: str) -> str:
    return tokens(x, L.NAME_STOPWORDS)


def address_tokens(x: str) -> str:
    return tokens(x, L.ADDRESS_STOPWORDS)


def grams(x: str) -> str:
    return f"(CASE WHEN {x} = '' THEN []::VARCHAR[] WHEN len({x}) < 3 THEN [{x}] ELSE list_distinct(list_transform(range(1, len({x}) - 1), lambda i: substr({x}, i, 3))) END)"


def significant(n: str, a: str) -> str:
    from_name = f"list_filter(string_split({n}, ' '), lambda t: len(t) >= 3 AND t NOT IN {_list(L.COMPANY_WORDS)})"
    stop = _list(dict.fromkeys(L.STREET_WORDS + L.COMPANY_WORDS))
    from_address = f"list_filter(string_split({a}, ' '), lambda t: (regexp_full_match(t, '[0-9]+') AND len(t) >= 2) OR (len(t) >= 4 AND t NOT IN {stop}))"
    return f"list_distinct(list_concat({from_name}, {from_address}))"


def padded(x: str) -> str:
    """With repeats."""
    word = "' ' || w || ' '"
    per_word = f"lambda w: flatten(list_transform(range(2, least(4, len({word})) + 1), lambda n: list_transform(range(1, len({word}) - n + 2), lambda i: substr({word}, i, n))))"
    return f"flatten(list_transform(list_filter(string_split({x}, ' '), lambda w: w <> ''), {per_word}))"


def jaccard(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"(CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE {both}::DOUBLE / (len({a}) + len({b}) - {both}) END)::DOUBLE"


def containment(a: str, b: str) -> str:
    return f"(CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0 WHEN len({a}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / len({a}) END)::DOUBLE"


def length_ratio(a: str, b: str) -> str:
    return f"(CASE WHEN greatest(len({a}), len({b})) = 0 THEN 1.0 ELSE least(len({a}), len({b}))::DOUBLE / greatest(len({a}), len({b})) END)::DOUBLE"


def f05(t: str, p: str, h: str) -> str:
    return f"(CASE WHEN {t} = 0 AND {p} = 0 THEN 1.0 WHEN {t} = 0 OR {p} = 0 OR {h} = 0 THEN 0.0 ELSE 1.25 * ({h}::DOUBLE / {p}) * ({h}::DOUBLE / {t}) / (0.25 * ({h}::DOUBLE / {p}) + ({h}::DOUBLE / {t})) END)::DOUBLE"


# --- common table expressions, each with those it needs ---

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "flat": ((), r"SELECT doc_id, lang, regexp_replace(coalesce(text, ''), '\s+', ' ', 'g') AS x FROM documents"),
    "rec": (("flat",), "SELECT 'S' || (doc_id % 3 + 1) || '-' || lpad(doc_id::VARCHAR, 8, '0') AS entity_id, substr(x, 1, 48) AS business_name, substr(x, 49, 64) AS business_address, coalesce(lang, '') AS country, substr(x, 113) AS body, doc_id AS row_pos FROM flat"),
    "nrm": (("rec",), f"SELECT entity_id, row_pos, {name('business_name')} AS name_norm, {address('business_address')} AS addr_norm, lower(trim(country)) AS country_norm FROM rec"),
    "s1": (("nrm",), "SELECT * FROM nrm WHERE entity_id LIKE 'S1-%'"),
    "s23": (("nrm",), "SELECT * FROM nrm WHERE entity_id NOT LIKE 'S1-%'"),
    "truth": (("rec",), "SELECT min(a.entity_id) AS sid, b.entity_id AS cid FROM rec a JOIN rec b ON a.country = b.country AND a.body = b.body WHERE length(a.body) >= 60 AND a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%' GROUP BY b.entity_id"),
    "t1": (("s1",), f"SELECT country_norm, entity_id AS sid, unnest({significant('name_norm', 'addr_norm')}) AS token FROM s1"),
    "t23": (("s23",), f"SELECT country_norm, entity_id AS cid, unnest({significant('name_norm', 'addr_norm')}) AS token FROM s23"),
    "idx": (("t23",), f"SELECT * FROM (SELECT country_norm, token, cid, count(*) OVER (PARTITION BY country_norm, token) AS df FROM t23) WHERE df BETWEEN {L.MIN_DF} AND {L.MAX_DF}"),
    "tok": (("t1", "idx"), f"SELECT * FROM (SELECT sid, cid, n_shared, row_number() OVER (PARTITION BY sid ORDER BY n_shared DESC, cid) AS tok_rank FROM (SELECT sid, cid, count(*) AS n_shared FROM t1 JOIN idx USING (country_norm, token) GROUP BY sid, cid)) WHERE tok_rank <= {L.TOP_TOKENS}"),
    "grm": (("nrm",), f"SELECT country_norm, entity_id, field, term, count(*) AS tf FROM (SELECT country_norm, entity_id, 'n' AS field, unnest({padded('name_norm')}) AS term FROM nrm UNION ALL SELECT country_norm, entity_id, 'a' AS field, unnest({padded('addr_norm')}) AS term FROM nrm) GROUP BY ALL"),
    "voc": (("grm",), f"SELECT country_norm, field, term, df, n_docs FROM (SELECT country_norm, field, term, count(*) AS df, row_number() OVER (PARTITION BY country_norm, field ORDER BY sum(tf) DESC, term) AS r FROM grm GROUP BY country_norm, field, term HAVING count(*) >= {L.VOCABULARY_MIN_DF}) JOIN (SELECT country_norm, count(*) AS n_docs FROM nrm GROUP BY country_norm) USING (country_norm) WHERE r <= {L.VOCABULARY}"),
    "raw": (("voc",), "SELECT country_norm, entity_id, field, term, (1 + ln(tf)) * (ln((1 + n_docs) / (1 + df)) + 1) AS w FROM grm JOIN voc USING (country_norm, field, term)"),
    "tfi": (("raw",), "SELECT country_norm, entity_id, field, term, w / sqrt(sum(w * w) OVER (PARTITION BY entity_id, field)) AS weight FROM raw"),
    "scl": (("tfi",), f"SELECT country_norm, entity_id, field, term, weight * CASE field WHEN 'n' THEN {L.NAME_WEIGHT} ELSE {L.ADDRESS_WEIGHT} END AS w FROM tfi"),
    "vec": (("scl",), "SELECT country_norm, entity_id, field, term, w / sqrt(sum(w * w) OVER (PARTITION BY entity_id)) AS weight FROM scl"),
    "cos": (("vec",), f"SELECT sid, cid, score, cos_rank FROM (SELECT sid, cid, score, row_number() OVER (PARTITION BY sid ORDER BY score DESC, cid) AS cos_rank FROM (SELECT a.entity_id AS sid, b.entity_id AS cid, round(sum(a.weight * b.weight), 6) AS score FROM vec a JOIN vec b USING (country_norm, field, term) WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%' GROUP BY 1, 2) WHERE score > 0) WHERE cos_rank <= {L.TOP_COSINE}"),
    "uni": (("cos", "tok"), "SELECT sid, cid, cos_rank, tok_rank, row_number() OVER (PARTITION BY sid ORDER BY cos_rank NULLS LAST, tok_rank NULLS LAST, cid) AS rank FROM cos FULL JOIN tok USING (sid, cid)"),
    "prt": (("nrm",), f"SELECT *, {name_tokens('name_norm')} AS name_tokens, {address_tokens('addr_norm')} AS addr_tokens, {grams('name_norm')} AS name_grams, {grams('addr_norm')} AS addr_grams, list_filter({address_tokens('addr_norm')}, lambda t: regexp_full_match(t, '[0-9]+')) AS numbers FROM nrm"),
    "pr": (("prt", "uni"), "SELECT sid, cid, a.name_norm AS an, b.name_norm AS bn, a.addr_norm AS aa, b.addr_norm AS ba, a.country_norm AS ac, b.country_norm AS bc, a.name_tokens AS ant, b.name_tokens AS bnt, a.addr_tokens AS aat, b.addr_tokens AS bat, a.name_grams AS ang, b.name_grams AS bng, a.addr_grams AS aag, b.addr_grams AS bag, a.numbers AS anum, b.numbers AS bnum, a.row_pos AS s1_pos FROM uni JOIN prt a ON a.entity_id = sid JOIN prt b ON b.entity_id = cid"),
    "sco": (("pr",), f"SELECT sid, cid, s1_pos, (an = bn AND aa = ba AND an <> '' AND aa <> '') AS is_exact, CASE WHEN an = bn AND aa = ba AND an <> '' AND aa <> '' THEN 1.0 ELSE round({jaccard('ang', 'bng')} * {jaccard('aag', 'bag')}, 6) END::DOUBLE AS p FROM pr"),
    "bst": (("sco",), "SELECT sid, cid, p, is_exact FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY p DESC, is_exact DESC, s1_pos, sid) AS r FROM sco) WHERE r = 1"),
    "res": (("bst",), "SELECT * FROM bst WHERE p >= 0.5"),
    "lab": (("uni", "truth"), "SELECT uni.sid, uni.cid, CASE WHEN truth.cid IS NULL THEN 0 ELSE 1 END AS label FROM uni LEFT JOIN truth ON truth.sid = uni.sid AND truth.cid = uni.cid"),
    "neg": (("lab",), f"SELECT sid, cid, label FROM (SELECT *, sum(label) OVER (PARTITION BY sid) AS pos, row_number() OVER (PARTITION BY sid, label ORDER BY md5(sid || '|' || cid), cid) AS r FROM lab) WHERE label = 1 OR r <= greatest({L.NEGATIVES_PER_POSITIVE} * pos, 1)"),
    "ent": (("s1", "truth", "res"), "SELECT s.entity_id AS sid, coalesce(n_true, 0) AS n_true, coalesce(n_pred, 0) AS n_pred, coalesce(n_hit, 0) AS n_hit FROM s1 s LEFT JOIN (SELECT coalesce(t.sid, r.sid) AS sid, count(t.cid) AS n_true, count(r.cid) AS n_pred, count(CASE WHEN t.cid IS NOT NULL AND r.cid IS NOT NULL THEN 1 END) AS n_hit FROM truth t FULL JOIN res r ON t.sid = r.sid AND t.cid = r.cid GROUP BY 1) c ON c.sid = s.entity_id"),
    "mat": (("s1", "res"), "SELECT s.row_pos, s.entity_id AS source1_entity_id, coalesce(string_agg(r.cid, ',' ORDER BY r.cid), '') AS matched_entity_ids FROM s1 s LEFT JOIN res r ON r.sid = s.entity_id GROUP BY s.row_pos, s.entity_id"),
    "can": (("s1", "uni", "res"), "SELECT s.row_pos, s.entity_id AS source1_entity_id, coalesce(string_agg(cid, ',' ORDER BY k, cid), '') AS candidate_entity_ids FROM s1 s LEFT JOIN (SELECT sid, cid, min(k) AS k FROM (SELECT sid, cid, rank AS k FROM uni UNION ALL SELECT sid, cid, 1000000 AS k FROM res) GROUP BY sid, cid) c ON c.sid = s.entity_id GROUP BY s.row_pos, s.entity_id"),
}


def sql(select: str, *needs: str) -> str:
    """A query over common table expressions, which bring their own needs."""
    order: list[str] = []

    def add(cte: str) -> None:
        for n in CTES[cte][0]:
            add(n)
        if cte not in order:
            order.append(cte)

    for n in needs:
        add(n)
    return ("WITH " + ",\n".join(f"{c} AS MATERIALIZED ({CTES[c][1]})" for c in order) + "\n" if order else "") + select


# --- edit ratios: the longest common subsequence, bit-parallel in 128-bit integers ---


def masks(a: str, b: str) -> str:
    """For each character of b, the set of its places in a as bits."""
    return f"list_transform(string_split({b}, ''), lambda c: coalesce(list_sum(list_transform(range(0, len({a})), lambda i: CASE WHEN substr({a}, i + 1, 1) = c THEN 1::HUGEINT << i::INTEGER ELSE 0::HUGEINT END)), 0)::HUGEINT)"


def lcs(found: str, m: str) -> str:
    """Of a string of m characters with the one whose masks are found."""
    full = f"((1::HUGEINT << ({m})::INTEGER) - 1)"
    return f"(({m}) - bit_count(list_reduce({found}, lambda s, u: ((s + (s & u)) | (s - (s & u))) & {full}, {full})))"


def _partial(s: str, t: str, found: str) -> str:
    part = f"{found}[greatest(0, k) + 1:least(len({t}), k + len({s}))]"
    size = f"(least(len({t}), k + len({s})) - greatest(0, k))"
    return f"list_max(list_transform(range(1 - len({s}), len({t})), lambda k: 2.0::DOUBLE * {lcs(part, f'len({s})')} / (len({s}) + {size})))"


def _set_parts(x: str, y: str) -> tuple[str, str, str]:
    a, b = (f"list_filter(list_distinct(string_split({v}, ' ')), lambda t: t <> '')" for v in (x, y))
    minus = lambda p, q: f"array_to_string(list_sort(list_filter({p}, lambda t: NOT list_contains({q}, t))), ' ')"
    return minus(a, b), minus(b, a), f"array_to_string(list_sort(list_intersect({a}, {b})), ' ')"


def _edit_ctes() -> None:
    first, second, third = ["sid", "cid"], ["*"], ["sid", "cid"]
    for f, x, y in (("n", "an", "bn"), ("a", "aa", "ba")):
        ab, ba, sect = _set_parts(x, y)
        joined = lambda v: f"array_to_string(list_sort(string_split({v}, ' ')), ' ')"
        short, long = (f"CASE WHEN len({x}) <= len({y}) THEN {p} ELSE {q} END" for p, q in ((x, y), (y, x)))
        first += [f"{x} AS x_{f}", f"{y} AS y_{f}", f"{short} AS s_{f}", f"{long} AS t_{f}", f"{joined(x)} AS p_{f}", f"{joined(y)} AS q_{f}", f"{ab} AS d_{f}", f"{ba} AS e_{f}", f"len({sect}) AS k_{f}"]
        second += [f"{masks(f's_{f}', f't_{f}')} AS ms_{f}", f"CASE WHEN len(s_{f}) = len(t_{f}) THEN {masks(f't_{f}', f's_{f}')} ELSE [] END AS mt_{f}", f"{masks(f'p_{f}', f'q_{f}')} AS mp_{f}", f"{masks(f'd_{f}', f'e_{f}')} AS md_{f}"]
        s, t, p, q, d, e, k = (f"{v}_{f}" for v in "stpqdek")
        name = {"n": "name", "a": "addr"}[f]
        guard = lambda v: f"(CASE WHEN len({s}) = 0 AND len({t}) = 0 THEN 1.0 WHEN len({s}) = 0 THEN 0.0 ELSE {v} END)::DOUBLE"  # noqa: E731, B023
        both = _partial(s, t, f"ms_{f}")
        back = _partial(t, s, f"mt_{f}")
        gap = f"(CASE WHEN {k} > 0 THEN 1 ELSE 0 END)"
        la, lb = f"({k} + {gap} + len({d}))", f"({k} + {gap} + len({e}))"
        diff = f"1 - (len({d}) + len({e}) - 2 * {lcs(f'md_{f}', f'len({d})')})::DOUBLE / ({la} + {lb})"
        sets = f"CASE WHEN {k} > 0 AND (len({d}) = 0 OR len({e}) = 0) THEN 1.0 WHEN {k} = 0 THEN {diff} ELSE greatest({diff}, 1 - (1 + len({d}))::DOUBLE / ({k} + {la}), 1 - (1 + len({e}))::DOUBLE / ({k} + {lb})) END"
        third += [
            f"{guard(f'2.0::DOUBLE * {lcs(f"ms_{f}", f"len({s})")} / (len({s}) + len({t}))')} AS {name}_levenshtein",
            f"{guard(f'2.0::DOUBLE * {lcs(f"mp_{f}", f"len({p})")} / (len({p}) + len({q}))')} AS {name}_token_sort",
            f"{guard(sets)} AS {name}_token_set",
            f"{guard(f'CASE WHEN len({s}) = len({t}) THEN greatest({both}, {back}) ELSE {both} END')} AS {name}_partial",
        ]
    CTES["edi"] = (("pr",), f"SELECT {', '.join(first)} FROM pr")
    CTES["msk"] = (("edi",), f"SELECT {', '.join(second)} FROM edi")
    CTES["rat"] = (("msk",), f"SELECT {', '.join(third)} FROM msk")
    mean = lambda v: f"({v}_levenshtein + {v}_token_sort + {v}_token_set) / 3"
    CTES["cmb"] = (("rat",), f"SELECT *, {mean('name')} AS name_avg_sim, {mean('addr')} AS addr_avg_sim, ({mean('name')}) * ({mean('addr')}) AS name_addr_interaction, least({mean('name')}, {mean('addr')}) AS min_name_addr FROM rat")


_edit_ctes()
