"""SQL over the driver's tables that gives the same rows as ``driver_queries``.

Written for the checking database; Spark never runs these.
"""

from __future__ import annotations

from .operators.keywords import STOP_WORDS, VOCABULARY
from .operators.ontology import CLASSES, DEFAULT_NAMESPACE, PROPERTIES, SUBCLASSES
from .operators.triples import RDF_TYPE, RDFS, XSD
from .plans.bibliography import REVIEW_TEXT
from .views import BIBLIOGRAPHY, TYPED_COLUMNS, _TABLES, _key

NS = DEFAULT_NAMESPACE


def _view(name: str) -> str:
    return BIBLIOGRAPHY[name].format(**{t: t for t in _TABLES}, papers="papers")


def _ctes(*ctes: tuple[str, str], body: str, recursive: bool = False) -> str:
    listed = ",\n".join(f"{name} AS ({sql})" for name, sql in ctes)
    return f"WITH {'RECURSIVE ' if recursive else ''}{listed}\n{body}"


PAPERS = ("papers", _view("papers"))
YEAR = "TRY_CAST(TRY_CAST(trim(year) AS DOUBLE) AS INT)"
EXPLODED = ("auth0", "SELECT DISTINCT record_type, num, key, unnest(string_split(author, '|')) AS author FROM papers")
AUTHORSHIP = (
    "auth",
    "SELECT DISTINCT record_type, key, author, contains(key, string_split(author, ' ')[-1]) AS is_lead FROM auth0",
)
BASE = [PAPERS, EXPLODED, AUTHORSHIP]


def _on_papers(body: str, *more: tuple[str, str]) -> str:
    return _ctes(*BASE, *more, body=body)


# Texts and keywords

_STOP = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
_VOCABULARY = "(" + ", ".join(f"'{w}'" for w in VOCABULARY) + ")"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{Nd}}]+'), lambda w: w <> '')"


def _keyword_ctes(source: str, key: str, text: str, kw: str = "kw") -> list[tuple[str, str]]:
    return [
        (f"{kw}_words", f"SELECT {key} AS k, {_words(text)} AS w FROM {source}"),
        (
            f"{kw}_terms",
            f"""SELECT k, unnest(list_filter(list_concat(w, list_transform(range(1, len(w)),
                lambda i: w[i] || ' ' || w[i + 1])),
                lambda t: NOT list_has_any(string_split(t, ' '), {_STOP}))) AS term FROM {kw}_words""",
        ),
        (f"{kw}_tf", f"SELECT k, term, count(*) AS tf FROM {kw}_terms GROUP BY k, term"),
        (f"{kw}_df", f"SELECT term, count(*) AS df FROM {kw}_tf GROUP BY term"),
        (
            f"{kw}_rank",
            f"""SELECT k, term, row_number() OVER (PARTITION BY k ORDER BY term IN {_VOCABULARY} DESC,
                round(tf * ln((1.0::DOUBLE + (SELECT count(*) FROM {kw}_words)) / (1.0::DOUBLE + df)), 9) DESC,
                term) AS r
                FROM {kw}_tf JOIN {kw}_df USING (term)""",
        ),
        (kw, f"SELECT k, string_agg(term, '|' ORDER BY r) AS keywords FROM {kw}_rank WHERE r <= 5 GROUP BY k"),
    ]


def _last_mentions(source: str, key: str, text: str, gazetteer: str, pairs: bool) -> list[tuple[str, str]]:
    two = "UNION ALL SELECT k, w[i] || ' ' || w[i + 1] AS term, i + 1 AS pos FROM vm_pos WHERE i < len(w)" if pairs else ""
    return [
        ("vm_words", f"SELECT {key} AS k, {_words(text)} AS w FROM {source}"),
        ("vm_pos", "SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM vm_words"),
        ("vm_terms", f"SELECT k, w[i] AS term, i AS pos FROM vm_pos {two}"),
        ("vm_names", f"SELECT DISTINCT kind, lower(name) AS term FROM ({gazetteer})"),
        (
            "vm_last",
            """SELECT k, kind, arg_max(term, (pos, length(term), term)) AS term
               FROM vm_terms JOIN vm_names USING (term) GROUP BY k, kind""",
        ),
        (
            "vm",
            """SELECT c.k, c.term AS city, n.term AS country FROM vm_last c JOIN vm_last n
               ON c.k = n.k AND c.kind = 'city' AND n.kind = 'country'""",
        ),
    ]


# Types

_VALUE_TYPE = r"""CASE WHEN v IS NULL OR v = '' THEN 'any'
  WHEN regexp_full_match(v, '\p{Nd}+') THEN 'integer'
  WHEN regexp_full_match(v, '\p{Nd}+\.\p{Nd}+') THEN 'float'
  WHEN regexp_full_match(v, '\d{4}-\d{2}-\d{2}') THEN
    CASE WHEN TRY_CAST(v AS DATE) IS NOT NULL THEN 'date' ELSE 'string' END
  WHEN regexp_full_match(v, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2})?') THEN
    CASE WHEN TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 'datetime' ELSE 'string' END
  WHEN lower(v) IN ('true', 'false') THEN 'boolean' ELSE 'string' END"""

_CELLS = "\nUNION ALL ".join(
    f"SELECT '{t}' AS record_type, '{c}' AS \"column\", CAST({e} AS VARCHAR) AS v, false AS multi FROM {t}"
    for t, columns in TYPED_COLUMNS.items()
    for c, e in columns.items()
) + """
UNION ALL SELECT 'part', 'tags', unnest([p_brand, p_type]), true FROM part"""

_TYPED = [
    ("cells", _CELLS),
    ("kinds", f"SELECT record_type, \"column\", {_VALUE_TYPE} AS t, multi FROM cells"),
    (
        "seen",
        """SELECT record_type, "column", bool_or(multi) AS is_multi,
           list_sort(list(DISTINCT t) FILTER (t <> 'any')) AS ts FROM kinds GROUP BY ALL""",
    ),
    (
        "types",
        """SELECT record_type, "column", CASE WHEN ts IS NULL OR len(ts) = 0 THEN 'string' WHEN len(ts) = 1 THEN ts[1]
           WHEN ts = ['float', 'integer'] THEN 'float' WHEN ts = ['date', 'datetime'] THEN 'datetime'
           ELSE 'string' END AS type, is_multi FROM seen""",
    ),
]

# XML

_XML_RECORDS = """
SELECT record_type, key, concat('R&D ', title, ' ') AS title, trim(year) AS year,
       CASE WHEN record_type = 'article' THEN journal ELSE booktitle END AS venue,
       array_to_string(list_sort(string_split(author, '|')), '|') AS authors,
       array_to_string(list_sort(list_transform(string_split(author, '|'), lambda a: string_split(a, ' ')[-1])), '|') AS orcids
FROM papers"""

_XML_COLUMNS = """
SELECT record_type, string_agg(DISTINCT c, '|' ORDER BY c) AS columns FROM (
  SELECT record_type, unnest(['key', 'mdate', 'author', 'author-orcid', 'title', 'i', 'year', 'cite']) AS c FROM papers
  UNION ALL SELECT record_type, CASE record_type WHEN 'article' THEN 'journal' ELSE 'booktitle' END
  FROM papers WHERE booktitle IS NOT NULL
  UNION ALL SELECT record_type, 'note' FROM papers WHERE num % 9 = 0) GROUP BY record_type"""

_CITED = _key("CAST(floor(num / 2) AS BIGINT)")

# Trade graph


def _trade(closed: bool = True) -> list[tuple[str, str]]:
    back = "UNION ALL SELECT 'N' || c_nationkey, 'C' || c_custkey, 1 FROM customer" if closed else ""
    return [
        (
            "e",
            f"""SELECT src, dst, min(w)::BIGINT AS weight FROM (
            SELECT 'C' || o_custkey AS src, 'O' || o_orderkey AS dst, 1 AS w FROM orders
            UNION ALL SELECT 'O' || l_orderkey, 'P' || l_partkey, trunc(l_quantity)::BIGINT FROM lineitem
            UNION ALL SELECT 'P' || l_partkey, 'S' || l_suppkey, l_linenumber FROM lineitem
            UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, 1 FROM supplier {back}) GROUP BY src, dst""",
        ),
        ("v", "SELECT src AS id FROM e UNION SELECT dst FROM e"),
    ]


_MONEY = (
    "money",
    """SELECT 'C' || c_custkey AS id, round(c_acctbal * 100)::BIGINT AS value FROM customer
       UNION ALL SELECT 'O' || o_orderkey, round(o_totalprice * 100)::BIGINT FROM orders
       UNION ALL SELECT 'P' || p_partkey, round(p_retailprice * 100)::BIGINT FROM part
       UNION ALL SELECT 'S' || s_suppkey, round(s_acctbal * 100)::BIGINT FROM supplier
       UNION ALL SELECT 'N' || n_nationkey, 0 FROM nation""",
)

_BUILT = (
    "built",
    """SELECT id, value FROM money WHERE id NOT LIKE 'S%'
       UNION ALL SELECT id, 1 FROM v WHERE id NOT IN (SELECT id FROM money WHERE id NOT LIKE 'S%')""",
)


def _named(items: list[tuple[str, str]]) -> str:
    return ",\n".join(f"{n} AS ({q})" for n, q in items)


_DIST = """d(id, dist) USING KEY (id) AS (
  SELECT 'C0', 0::BIGINT
  UNION
  SELECT e.dst, min(d.dist + e.weight) FROM d JOIN e ON e.src = d.id
  LEFT JOIN recurring.d AS r ON r.id = e.dst
  WHERE r.dist IS NULL OR d.dist + e.weight < r.dist GROUP BY e.dst)"""

_SSSP = f"""WITH RECURSIVE {_named(_trade())}, {_DIST}
SELECT v.id, d.dist FROM v LEFT JOIN d ON d.id = v.id"""

_PATHS = f"""WITH RECURSIVE {_named(_trade())}, {_DIST},
best AS MATERIALIZED (SELECT * FROM d),
tight AS MATERIALIZED (SELECT e.src, e.dst FROM e JOIN best a ON a.id = e.src JOIN best b ON b.id = e.dst
          WHERE a.dist + e.weight = b.dist),
h(id, hops) USING KEY (id) AS (
  SELECT 'C0', 0 UNION
  SELECT t.dst, min(h.hops + 1) FROM h JOIN tight t ON t.src = h.id
  LEFT JOIN recurring.h AS r ON r.id = t.dst WHERE r.hops IS NULL OR h.hops + 1 < r.hops GROUP BY t.dst),
level AS MATERIALIZED (SELECT * FROM h),
parent AS MATERIALIZED (SELECT t.dst AS id, min(t.src) AS up FROM tight t JOIN level a ON a.id = t.src JOIN level b ON b.id = t.dst
           WHERE a.hops + 1 = b.hops GROUP BY t.dst),
p(id, path) AS (SELECT 'C0', 'C0' UNION ALL
  SELECT parent.id, p.path || ',' || parent.id FROM p JOIN parent ON parent.up = p.id)
SELECT v.id, best.dist, p.path FROM v LEFT JOIN best ON best.id = v.id LEFT JOIN p ON p.id = v.id"""

_MAX_REACH = f"""WITH RECURSIVE {_named([*_trade(closed=False), _MONEY])},
m(id, value) USING KEY (id) AS (
  SELECT id, value FROM money UNION
  SELECT e.dst, max(m.value) FROM m JOIN e ON e.src = m.id LEFT JOIN recurring.m AS r ON r.id = e.dst
  WHERE m.value > r.value GROUP BY e.dst)
SELECT id, value FROM m"""


def _ranks(name: str, reset: float, rounds: int) -> str:
    return f"""{name}(it, id, rank) AS (
  SELECT 0, id, 1.0::DOUBLE FROM v UNION ALL
  SELECT {name}.it + 1, f.dst, {reset}::DOUBLE + {1.0 - reset}::DOUBLE * sum({name}.rank * f.share)
  FROM {name} JOIN flow f ON f.src = {name}.id WHERE {name}.it < {rounds} GROUP BY {name}.it, f.dst)"""


_FLOW = (
    "flow",
    """SELECT src, dst, 1.0::DOUBLE / count(*) OVER (PARTITION BY src) AS share FROM e
       UNION ALL SELECT id, id, 0.0::DOUBLE FROM v""",
)


def _scaled(name: str, reset: float, it: int) -> str:
    return f"""SELECT id, {reset}::DOUBLE AS reset_prob, {it}::INT AS max_iter,
  round(rank * (SELECT count(*) FROM v) / (SELECT sum(rank) FROM {name} WHERE it = {it}), 6) AS pagerank
  FROM {name} WHERE it = {it}"""


_PAGERANK = f"""WITH RECURSIVE {_named([*_trade(), _FLOW])}, {_ranks('pr', 0.7, 20)}
SELECT id, pagerank FROM ({_scaled('pr', 0.7, 20)})"""

_SWEEP = f"""WITH RECURSIVE {_named([*_trade(), _FLOW])}, {_ranks('a', 0.7, 20)}, {_ranks('b', 0.15, 20)}
{' UNION ALL '.join(_scaled(n, p, i) for n, p in (('a', 0.7), ('b', 0.15)) for i in (2, 4, 20))}"""

# Property graph

_P = "'Paper:' || key"
_CONF = f"'Conference:' || booktitle || '|' || {YEAR}"
_JOUR = f"'Journal:' || journal || '|' || {YEAR} || '|' || volume"


def _half(kind: str) -> str:
    return f"(SELECT * FROM papers WHERE record_type = '{kind}')"


_VENUES = _last_mentions(_half("inproceedings"), "key", "title", _view("gazetteer"), pairs=True)
_PLACES = (
    "places",
    """SELECT DISTINCT booktitle, title, year, city, country FROM papers JOIN vm ON vm.k = papers.key
       WHERE booktitle IS NOT NULL""",
)

_CONF_PAPERS = ("cp", f"""SELECT DISTINCT key, title, booktitle, {YEAR}::VARCHAR AS year FROM papers
    WHERE record_type = 'inproceedings' AND booktitle IS NOT NULL""")
_JOUR_PAPERS = ("jp", f"""SELECT DISTINCT key, title, journal, {YEAR}::VARCHAR AS year, volume FROM papers
    WHERE record_type = 'article' AND journal IS NOT NULL""")

_LOADS = {
    "conferences": f"""
        SELECT 'node' AS part, 'ConferenceTitle' AS kind, 'ConferenceTitle:' || booktitle AS a, '' AS b FROM cp WHERE year IS NOT NULL
        UNION SELECT 'node', 'Conference', {_CONF}, '' FROM cp
        UNION SELECT 'node', 'Year', 'Year:' || {YEAR}, '' FROM cp
        UNION SELECT 'edge', 'HAS_Edition', 'ConferenceTitle:' || booktitle, {_CONF} FROM cp
        UNION SELECT 'edge', 'HELD_IN', {_CONF}, 'Year:' || {YEAR} FROM cp""",
    "journals": f"""
        SELECT 'node' AS part, 'JournalTitle' AS kind, 'JournalTitle:' || journal AS a, '' AS b FROM jp
        UNION SELECT 'node', 'Journal', {_JOUR}, '' FROM jp
        UNION SELECT 'node', 'Year', 'Year:' || {YEAR}, '' FROM jp
        UNION SELECT 'edge', 'HAS_VOLUME', 'JournalTitle:' || journal, {_JOUR} FROM jp
        UNION SELECT 'edge', 'ISSUED_IN', {_JOUR}, 'Year:' || {YEAR} FROM jp""",
    "conference_papers": f"""
        SELECT 'node' AS part, 'Paper' AS kind, {_P} AS a, '' AS b FROM cp
        UNION SELECT 'node', 'Conference', {_CONF}, '' FROM cp
        UNION SELECT 'node', 'Keyword', 'Keyword:' || unnest(string_split(keywords, '|')), '' FROM ckw
        UNION SELECT 'edge', 'HAS', {_CONF}, {_P} FROM cp
        UNION SELECT 'edge', 'MENTIONS', 'Paper:' || k, 'Keyword:' || unnest(string_split(keywords, '|')) FROM ckw""",
    "journal_papers": f"""
        SELECT 'node' AS part, 'Paper' AS kind, {_P} AS a, '' AS b FROM jp
        UNION SELECT 'node', 'Journal', {_JOUR}, '' FROM jp
        UNION SELECT 'node', 'Keyword', 'Keyword:' || unnest(string_split(keywords, '|')), '' FROM jkw
        UNION SELECT 'edge', 'HAS', {_JOUR}, {_P} FROM jp
        UNION SELECT 'edge', 'MENTIONS', 'Paper:' || k, 'Keyword:' || unnest(string_split(keywords, '|')) FROM jkw""",
    "places": f"""
        SELECT 'node' AS part, 'Place' AS kind, 'Place:' || city || '|' || country AS a, '' AS b FROM places
        UNION SELECT 'node', 'Conference', {_CONF}, '' FROM places
        UNION SELECT 'node', 'Year', 'Year:' || {YEAR}, '' FROM places
        UNION SELECT 'edge', 'LOCATE_AT', {_CONF}, 'Place:' || city || '|' || country FROM places
        UNION SELECT 'edge', 'HELD_IN', {_CONF}, 'Year:' || {YEAR} FROM places""",
    "authors": f"""
        SELECT 'node' AS part, 'Paper' AS kind, {_P} AS a, '' AS b FROM auth
        UNION SELECT 'node', 'Author', 'Author:' || author, '' FROM auth
        UNION SELECT 'edge', 'WRITES', 'Author:' || author, {_P} FROM auth""",
}
_GRAPH_CTES = [
    *BASE, *_VENUES, _PLACES, _CONF_PAPERS, _JOUR_PAPERS,
    *_keyword_ctes("cp", "key", "title", "ckw"), *_keyword_ctes("jp", "key", "title", "jkw"),
]


def _draw(seed: str, key: str, n: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{seed}', {key})), 1, 15))::BIGINT % {n}"


_AFFILIATED = [
    ("orgs", f"SELECT organization, row_number() OVER (ORDER BY organization) - 1 AS no FROM (SELECT DISTINCT organization FROM ({_view('organizations')}))"),
    (
        "aff",
        f"""SELECT author, organization FROM (SELECT author, {_draw('affiliation', 'author', '(SELECT count(*) FROM orgs)')} AS no
            FROM (SELECT DISTINCT author FROM auth)) JOIN orgs USING (no)""",
    ),
]

_ALL_LOADS = "\nUNION ".join(f"SELECT part, kind, a, b FROM ({q})" for q in _LOADS.values())
_NODES_ALL = f"""
SELECT kind AS label, a AS id,
  CASE WHEN kind = 'Paper' THEN substr(a, 7) END AS key,
  CASE kind WHEN 'ConferenceTitle' THEN substr(a, 17) WHEN 'JournalTitle' THEN substr(a, 14)
            WHEN 'Conference' THEN string_split(substr(a, 12), '|')[1]
            WHEN 'Journal' THEN string_split(substr(a, 9), '|')[1] WHEN 'Paper' THEN f.title END AS title,
  CASE kind WHEN 'Year' THEN substr(a, 6) WHEN 'Conference' THEN string_split(a, '|')[2]
            WHEN 'Journal' THEN string_split(a, '|')[2] WHEN 'Paper' THEN f.year END AS year,
  CASE kind WHEN 'Journal' THEN string_split(a, '|')[3] END AS volume,
  NULL::VARCHAR AS abstract,
  CASE kind WHEN 'Author' THEN substr(a, 8) WHEN 'Keyword' THEN substr(a, 9) WHEN 'Organization' THEN substr(a, 14) END AS name,
  CASE kind WHEN 'Place' THEN string_split(substr(a, 7), '|')[1] END AS city,
  CASE kind WHEN 'Place' THEN string_split(a, '|')[2] END AS country
FROM (SELECT DISTINCT kind, a FROM loaded WHERE part = 'node' AND a IS NOT NULL) n
LEFT JOIN full_papers f ON n.kind = 'Paper' AND n.a = 'Paper:' || f.key"""
_FULL_PAPERS = ("full_papers", "SELECT key, title, year FROM cp UNION ALL SELECT key, title, year FROM jp")
_LOADED = ("loaded", _ALL_LOADS + " UNION SELECT 'node', 'Organization', 'Organization:' || organization, '' FROM aff")

_REVIEWERS = (
    "rv",
    """SELECT record_type, key, unnest(['Customer ' || lpad(CAST(num % 50 AS VARCHAR), 9, '0'),
       'Stranger ' || (num % 5), 'Clerk ' || lpad(CAST((num + 1) % 97 AS VARCHAR), 9, '0')]) AS reviewer FROM papers""",
)
_MATCHED = "SELECT DISTINCT record_type, 'Author:' || reviewer AS src, 'Paper:' || key AS dst FROM rv WHERE reviewer IN (SELECT author FROM auth)"

_CITED_BY = f"""SELECT DISTINCT 'Paper:' || cite AS src, 'Paper:' || id AS dst FROM ({_view('citations')})
        WHERE id IN (SELECT key FROM papers) AND cite IN (SELECT key FROM papers)"""

# Reviewer draws: enough turns that every record has its three.
_ASSIGN = [
    ("rows0", "SELECT key, author, row_number() OVER (ORDER BY key, author) - 1 AS no FROM (SELECT DISTINCT key, author FROM auth)"),
    (
        "draws",
        f"""SELECT key, i, {_draw('reviewers', "key, CAST(i AS VARCHAR)", '(SELECT count(*) FROM rows0)')} AS no
            FROM (SELECT DISTINCT key FROM auth), range(0, 60) t(i)""",
    ),
    ("valid", """SELECT d.key, r.author AS reviewer, min(i) AS i FROM draws d JOIN rows0 r USING (no)
        WHERE NOT EXISTS (SELECT 1 FROM rows0 o WHERE o.key = d.key AND o.author = r.author) GROUP BY 1, 2"""),
    ("ranked", "SELECT key, reviewer, row_number() OVER (PARTITION BY key ORDER BY i)::INT AS pick FROM valid"),
]

# Knowledge graph


def _iri(column: str) -> str:
    return f"'{NS}' || regexp_replace({column}, '[!-/:-@\\[-`{{-~ ]', '_', 'g')"


def _raw_iri(column: str) -> str:
    return f"'{NS}' || {column}"


def _triple(s: str, p: str, o: str, literal: bool, source: str, where: str = "true") -> str:
    predicate = p if p.startswith("http") else NS + p
    return f"SELECT {s} AS s, '{predicate}' AS p, CAST({o} AS VARCHAR) AS o, {str(literal).lower()} AS o_is_literal FROM {source} WHERE {where}"


_KG_VIEWS = [(n, _view(n)) for n in BIBLIOGRAPHY if n.startswith("kg_")]
_SENT = ("sent", """SELECT publication_id, edition_id, conf_id AS venue_id FROM kg_has_publication JOIN kg_has_proceedings USING (edition_id)
    UNION ALL SELECT publication_id, edition_id, journal_id FROM kg_has_publication JOIN kg_contains_volume USING (edition_id)""")

_ABOX = "\nUNION ".join(
    [
        _triple(_iri("id"), "title", "title", True, "kg_papers"),
        _triple(_iri("id"), "year", "year", True, "kg_papers"),
        _triple(_iri("id"), RDF_TYPE, _raw_iri("type"), False, "kg_papers"),
        _triple(_raw_iri("id"), RDF_TYPE, f"'{NS}Keyword'", False, "kg_keyword"),
        _triple(_raw_iri("id"), "word", "words", True, "kg_keyword"),
        _triple(_iri("author"), RDF_TYPE, f"'{NS}Author'", False, "auth"),
        _triple(_iri("author"), "name", "author", True, "auth"),
        _triple(_iri("author"), "writes", _iri("key"), False, "auth"),
        _triple(_iri("conf_id"), "cRelatedTo", _raw_iri("area_id"), False, "kg_conf_area"),
        _triple(_iri("conf_id"), RDF_TYPE, f"'{NS}' || replace(type, 'WorkGroup', 'ExpertGroup')", False, "kg_conferences", "type <> 'Other'"),
        _triple(_iri("conf_id"), "has", _iri("edition_id"), False, "kg_has_proceedings"),
        _triple(_iri("journal_id"), "contains", _iri("edition_id"), False, "kg_contains_volume"),
        _triple(_iri("conf_id"), "cHandledBy", _iri("chair_id"), False, "kg_cHandledBy"),
        _triple(_iri("journal_id"), "jRelatedTo", _raw_iri("area_id"), False, "kg_journal_area"),
        _triple(_iri("paper_id"), "pRelatedTo", _raw_iri("area_id"), False, "kg_paper_area"),
        _triple(_raw_iri("review_id"), "reviewText", "review_text", True, "kg_reviews"),
        _triple(_raw_iri("review_id"), "reviewDecision", "decision", True, "kg_reviews"),
        _triple(_iri("paper_id"), "isUnderReview", _raw_iri("review_id"), False, "kg_reviews"),
        _triple(_raw_iri("author_id"), "performs", _raw_iri("review_id"), False, "kg_reviews"),
        _triple(_iri("journal_id"), RDF_TYPE, f"'{NS}Journal'", False, "kg_journals"),
        _triple(_iri("journal_id"), "jHandledBy", _iri("editor_id"), False, "kg_jHandledBy"),
        _triple(_iri("publication_id"), "isSubmittedTo", _iri("venue_id"), False, "sent"),
        _triple(_iri("responsible_id"), "assigns", _iri("reviewer"), False, "kg_assignments"),
    ]
)
_KG = [*BASE, *_KG_VIEWS, _SENT, ("abox", f"SELECT DISTINCT * FROM ({_ABOX}) WHERE s IS NOT NULL AND o IS NOT NULL")]


def _tbox_values() -> str:
    rows = []
    for c in CLASSES:
        rows += [(c, RDF_TYPE, RDFS + "Class", False), (c, RDFS + "label", c, True)]
    for name, domain, rng, label in PROPERTIES:
        target = XSD + rng[4:] if rng.startswith("xsd:") else NS + rng
        rows += [
            (name, RDFS + "domain", NS + domain, False),
            (name, RDFS + "range", target, False),
            (name, RDFS + "label", label, True),
        ]
    for name, parent, label in SUBCLASSES:
        rows += [(name, RDFS + "subClassOf", NS + parent, False), (name, RDFS + "label", label, True)]
    values = ", ".join(f"('{NS}{s}', '{p}', '{o}', {str(lit).lower()})" for s, p, o, lit in rows)
    return f"SELECT * FROM (VALUES {values}) t(s, p, o, o_is_literal)"


_TBOX = ("tbox", _tbox_values())
_ALL = ("triples", "SELECT * FROM abox UNION SELECT * FROM tbox")
_NAMED_TITLES = f"""SELECT author, part, string_agg(title, ', ' ORDER BY title) AS titles FROM (
SELECT *, ((row_number() OVER (PARTITION BY author ORDER BY title) - 1) // 1000000)::INT AS part FROM (
SELECT DISTINCT n.o AS author, t.o AS title
FROM triples w JOIN triples t ON t.s = w.o AND t.p = '{NS}title' JOIN triples n ON n.s = w.s AND n.p = '{NS}name'
WHERE w.p = '{NS}writes' {{more}})) GROUP BY author, part"""
_BY_KEYWORD = f"""AND t.s IN (SELECT i.s FROM triples i JOIN triples r ON r.s = i.o AND r.p IN ('{NS}cRelatedTo', '{NS}jRelatedTo')
  JOIN triples k ON k.s = r.o AND k.p = '{NS}word' AND k.o = 'Brand#3' WHERE i.p = '{NS}isSubmittedTo')"""


def _domains(*classes: str) -> str:
    listed = ", ".join(f"'{NS}{c}'" for c in classes)
    return f"""SELECT d.p, count(u.p) AS n FROM (SELECT DISTINCT s AS p FROM triples WHERE p = '{RDFS}domain' AND o IN ({listed})) d
      LEFT JOIN triples u ON u.p = d.p GROUP BY d.p"""


_LINE = r"""SELECT '<' || s || '> <' || p || '> ' || CASE WHEN o_is_literal
  THEN '"' || replace(replace(replace(replace(replace(o, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') || '"'
  ELSE '<' || o || '>' END || ' .' AS line FROM abox"""


def _authors_of(kind: str) -> str:
    return _on_papers(f"SELECT key, author, CASE WHEN is_lead THEN 'lead' ELSE 'co' END AS part FROM auth WHERE record_type = '{kind}'")


_TYPED_RECORDS = ("r", "SELECT row_number() OVER (ORDER BY record_type, key) - 1 AS id, * FROM papers")
_TYPED_HEADER = "id:integer;author:string[];author-orcid:integer[];{before}cite:string{many};i:string;{after}key:string;mdate:date;note:string;title:string;year:string"
_RELATION_NODES = [
    ("n1", "SELECT author AS v, (SELECT count(*) FROM papers) + row_number() OVER (ORDER BY author) - 1 AS no FROM (SELECT DISTINCT author FROM auth0)"),
    ("n2", """SELECT v, (SELECT max(no) FROM n1) + row_number() OVER (ORDER BY v) AS no FROM (SELECT DISTINCT trim(year) AS v FROM papers)"""),
]
_TYPED_TABLES = f"""
SELECT 'cell' AS part, record_type AS kind, id, unnest(['key', 'year', 'mdate', 'author']) AS name,
  unnest([key, trim(year), '2020-01-01', array_to_string(list_sort(string_split(author, '|')), '|')]) AS value FROM r
UNION ALL SELECT 'header', 'article', NULL, '', '{_TYPED_HEADER.format(before='', many='', after='journal:string;')}'
UNION ALL SELECT 'header', 'inproceedings', NULL, '', '{_TYPED_HEADER.format(before='booktitle:string;', many='[]', after='')}'
UNION ALL SELECT 'node', 'author', no, '', v FROM n1
UNION ALL SELECT 'node', 'year', no, '', v FROM n2
UNION ALL SELECT 'edge', 'author', id, '', no::VARCHAR FROM r JOIN auth0 USING (key) JOIN n1 ON v = auth0.author
UNION ALL SELECT 'edge', 'year', id, '', no::VARCHAR FROM r JOIN n2 ON v = trim(year)"""

_DICTIONARY = [
    ("l", "SELECT author, min(CASE WHEN num % 3 = 0 THEN 1 WHEN num % 7 < 4 THEN 2 ELSE 3 END) AS l FROM auth0 GROUP BY author"),
    ("n", "SELECT author, 99 + row_number() OVER (ORDER BY l, author) AS no FROM l"),
]

ORACLES = {
    "xml_records": _on_papers(_XML_RECORDS),
    "schema_discovery": _on_papers(_XML_COLUMNS),
    "citation_pairs": _on_papers(f"SELECT key, {_CITED} AS cite FROM papers"),
    "csv_read_clean": "SELECT * FROM part",
    "write_csv_roundtrip": "SELECT * REPLACE ('say \"' || p_name || '\"; twice' AS p_name) FROM part",
    "csv_quoted_breaks": """SELECT doc_id, replace(text, ' ', chr(10) || '"a", ') || repeat(chr(10), 2) || '"' AS body, nullif(lang, '') AS lang FROM documents""",
    "typed_header_read": "SELECT p_partkey, p_name, list_aggregate(list_sort([p_brand, p_type]), 'string_agg', ',') AS tags, p_retailprice FROM part",
    "typed_header": _ctes(*_TYPED, body="""SELECT record_type, 'id:integer;' || string_agg("column" || ':' || type || CASE WHEN is_multi THEN '[]' ELSE '' END, ';' ORDER BY "column") AS header FROM types GROUP BY record_type"""),
    "infer_value_type": _ctes(*_TYPED, body="""SELECT record_type || '.' || "column" AS "column", t AS value_type, count(*) AS n FROM kinds GROUP BY ALL"""),
    "infer_column_type": _ctes(*_TYPED, body="""SELECT record_type, "column", type, is_multi FROM types"""),
    "tsv_edges": _ctes(*_trade(), body="SELECT src, dst FROM e"),
    "ntriples_lines": _ctes(*_KG, body=_LINE),
    "citation_counts": f"SELECT count(DISTINCT id) AS n_citing, count(DISTINCT cite) AS n_cited, (SELECT count(*) FROM (SELECT id FROM ({_view('citations')}) WHERE cite <> '...' UNION SELECT cite FROM ({_view('citations')}) WHERE cite <> '...')) AS n_either FROM ({_view('citations')}) WHERE cite <> '...'",
    "citation_subset_xml": _on_papers("SELECT record_type, key FROM papers WHERE key IN (SELECT key FROM c) OR key IN (SELECT cite FROM c)", ("c", f"SELECT key, {_CITED} AS cite FROM papers")),
    "citation_subset": _on_papers("SELECT record_type, key FROM papers WHERE key IN (SELECT id FROM c) OR key IN (SELECT cite FROM c)", ("c", f"SELECT * FROM ({_view('citations')}) WHERE cite <> '...'")),
    "project_distinct_notnull": "SELECT DISTINCT l_partkey, l_suppkey FROM (SELECT nullif(l_partkey, l_suppkey * 20) AS l_partkey, nullif(l_suppkey, 7) AS l_suppkey FROM lineitem) WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL",
    "lead_coauthor_split": _on_papers("SELECT key, author, is_lead FROM auth"),
    "trim_all": _on_papers("SELECT key, title, trim(year) AS year FROM papers"),
    "coerce_year": _on_papers(
        f"""SELECT DISTINCT booktitle, {YEAR} AS year, 'drop' AS bad_year FROM odd WHERE booktitle IS NOT NULL AND {YEAR} IS NOT NULL
        UNION ALL SELECT booktitle, {YEAR}, 'null' FROM (SELECT DISTINCT booktitle, year FROM odd WHERE booktitle IS NOT NULL AND year IS NOT NULL)""",
        ("odd", """SELECT booktitle, CASE num % 6 WHEN 0 THEN year || 'd' WHEN 1 THEN ' ' || year || ' ' WHEN 2 THEN year || 'f'
            WHEN 3 THEN year || '.0' ELSE year END AS year FROM papers"""),
    ),
    "explode_multivalue": _on_papers("SELECT key, unnest(string_split(author, '|')) AS author FROM papers"),
    "implode_multivalue": f"SELECT doc_id, coalesce(array_to_string(list_sort({_words('text')}), '|'), '') AS cell FROM documents",
    "mint_iri": _on_papers(f"SELECT key, {_iri('key')} AS iri, {_iri('booktitle')} AS venue_iri FROM papers"),
    "type_to_class": _ctes(PAPERS, ("c", _view("kg_conferences")), ("p", _view("kg_papers")), body=f"""
        SELECT {_iri('conf_id')} AS s, '{NS}' || replace(type, 'WorkGroup', 'ExpertGroup') AS o FROM c WHERE type <> 'Other' AND conf_id IS NOT NULL
        UNION ALL SELECT {_iri('id')}, '{NS}' || type FROM p WHERE type IN ('FullPaper', 'Poster')"""),
    "keywords_topk": _ctes(*_keyword_ctes("documents", "doc_id", "text"), body="SELECT k AS doc_id, keywords FROM kw"),
    "venue_last_mention": _ctes(*_last_mentions("documents", "doc_id", "text", f"SELECT CASE WHEN length(name) % 2 = 0 THEN 'city' ELSE 'country' END AS kind, name FROM (SELECT DISTINCT unnest({_words('text')}) AS name FROM benchmark)", False), body="SELECT k AS doc_id, city, country FROM vm"),
    "right_outer_join": _ctes(PAPERS, *_KG_VIEWS, body="SELECT e.edition_id, publication_id, conf_id FROM kg_has_publication p RIGHT JOIN kg_has_proceedings e ON p.edition_id = e.edition_id"),
    "venue_of_publication": _ctes(PAPERS, *_KG_VIEWS, _SENT, body="SELECT publication_id, edition_id, venue_id FROM sent"),
    "affiliation_edges": _on_papers("SELECT author, organization FROM aff", *_AFFILIATED),
    "assign_reviewers": _on_papers("SELECT key, reviewer, pick FROM ranked WHERE pick <= 3", *_ASSIGN),
    "reviewer_tables": _on_papers(f"""SELECT key, string_agg(reviewer, '|' ORDER BY pick) AS reviewer, '{REVIEW_TEXT}' AS textual_description
        FROM ranked WHERE pick <= 3 GROUP BY key""", *_ASSIGN),
    "authors_affiliation": _on_papers("SELECT author, organization AS affiliation FROM aff", *_AFFILIATED),
    "union_all_authors": _on_papers("SELECT author, count(*) AS n FROM auth GROUP BY author"),
    "extract_conferences": _ctes(PAPERS, body=f"SELECT DISTINCT booktitle, {YEAR} AS year FROM papers WHERE record_type = 'inproceedings' AND booktitle IS NOT NULL AND {YEAR} IS NOT NULL"),
    "extract_journals": _ctes(PAPERS, body=f"SELECT journal, volume, {YEAR} AS year FROM (SELECT DISTINCT journal, volume, year FROM papers WHERE record_type = 'article' AND journal IS NOT NULL AND volume IS NOT NULL AND year IS NOT NULL)"),
    "extract_conference_papers": _ctes(PAPERS, ("cq", f"SELECT DISTINCT key, title, booktitle, {YEAR} AS year FROM papers WHERE record_type = 'inproceedings' AND booktitle IS NOT NULL"), *_keyword_ctes("cq", "key", "title"), body="SELECT cq.*, keywords FROM cq LEFT JOIN kw ON kw.k = cq.key"),
    "extract_journal_papers": _ctes(PAPERS, ("jq", f"SELECT DISTINCT key, title, journal, {YEAR} AS year, volume FROM papers WHERE record_type = 'article' AND journal IS NOT NULL"), *_keyword_ctes("jq", "key", "title"), body="SELECT jq.*, keywords FROM jq LEFT JOIN kw ON kw.k = jq.key"),
    "extract_venues": _ctes(*BASE, *_VENUES, _PLACES, body="SELECT * FROM places"),
    "extract_conference_authors": _authors_of("inproceedings"),
    "extract_journal_authors": _authors_of("article"),
    **{
        f"load_{name}": _ctes(*_GRAPH_CTES, body=f"SELECT * FROM ({_LOADS[name]}) WHERE a IS NOT NULL AND b IS NOT NULL")
        for name in ("conferences", "journals", "conference_papers", "journal_papers", "places")
    },
    "nodes_all": _ctes(*_GRAPH_CTES, *_AFFILIATED, _FULL_PAPERS, _LOADED, body=_NODES_ALL),
    "nodes_paper": _ctes(*_GRAPH_CTES, _FULL_PAPERS, body="SELECT 'Paper:' || k.key AS id, k.key, title, year FROM (SELECT DISTINCT key FROM auth) k LEFT JOIN full_papers USING (key)"),
    "edges_all": _ctes(*_GRAPH_CTES, *_AFFILIATED, _LOADED, *_ASSIGN, body=f"""
        SELECT kind AS type, a AS src, b AS dst, NULL::BOOLEAN AS is_lead FROM loaded WHERE part = 'edge' AND kind <> 'WRITES' AND a IS NOT NULL AND b IS NOT NULL
        UNION ALL SELECT 'WRITES', 'Author:' || author, 'Paper:' || key, is_lead FROM auth
        UNION ALL SELECT 'IS_AFFILIATED_TO', 'Author:' || author, 'Organization:' || organization, NULL FROM aff
        UNION ALL SELECT DISTINCT 'REVIEWS', 'Author:' || reviewer, 'Paper:' || key, NULL FROM ranked WHERE pick <= 3
        UNION ALL SELECT 'CITED_BY', src, dst, NULL FROM ({_CITED_BY})"""),
    "edges_writes": _on_papers("SELECT 'Author:' || author AS src, 'Paper:' || key AS dst, is_lead FROM auth"),
    "review_edges": _on_papers(f"SELECT DISTINCT src, dst FROM ({_MATCHED})", _REVIEWERS),
    "review_evolve": _on_papers(f"""SELECT src, dst, CASE WHEN record_type = 'inproceedings' THEN 'accept' END AS decision,
        CASE WHEN record_type = 'inproceedings' THEN '{REVIEW_TEXT}' END AS textual_description FROM ({_MATCHED})""", _REVIEWERS),
    "citation_edges": _on_papers(_CITED_BY),
    "citation_file_edges": _on_papers(_CITED_BY),
    "relation_normalize": _on_papers("""SELECT 'node' AS part, no AS a, author AS b FROM n
        UNION ALL SELECT 'edge', num, CAST(no AS VARCHAR) FROM auth0 JOIN n USING (author)""",
        ("n", "SELECT author, row_number() OVER (ORDER BY author) - 1 AS no FROM (SELECT DISTINCT author FROM auth0)")),
    "dense_ids": _ctes(PAPERS, body="SELECT row_number() OVER (ORDER BY key) - 1 AS id, key FROM papers"),
    "xml_to_tables": _ctes(PAPERS, body=f"""SELECT row_number() OVER (ORDER BY record_type, key) - 1 AS id, key,
        array_to_string(list_sort(string_split(author, '|')), '|') AS author, concat('R&D ', title, ' ') AS title, trim(year) AS year,
        CASE WHEN num % 10 = 0 THEN '...|' ELSE '' END || {_CITED} AS cite, record_type FROM papers"""),
    "xml_typed_tables": _on_papers(_TYPED_TABLES, _TYPED_RECORDS, *_RELATION_NODES),
    "id_dictionary_second_load": _on_papers("""SELECT 'node' AS part, no AS a, author AS b FROM n
        UNION ALL SELECT 'edge', num, CAST(no AS VARCHAR) FROM auth0 JOIN n USING (author)""", *_DICTIONARY),
    "graph_merge_incremental": _ctes(*_GRAPH_CTES, body=f"""SELECT part, kind, a, CASE WHEN part = 'node' AND kind = 'Paper' THEN title ELSE b END AS b
        FROM ({_LOADS['conferences']} UNION {_LOADS['journals']} UNION {_LOADS['authors']}) LEFT JOIN papers ON a = 'Paper:' || key
        WHERE a IS NOT NULL AND b IS NOT NULL"""),
    "graph_build": _ctes(*_trade(), _MONEY, _BUILT, body="SELECT id, value FROM built"),
    "triplets": _ctes(*_trade(), _MONEY, _BUILT, body="SELECT src, dst, weight, a.value AS src_value, b.value AS dst_value FROM e JOIN built a ON a.id = src JOIN built b ON b.id = dst"),
    "graph_max_value": _ctes(_MONEY, body="SELECT max(value) AS max_value FROM money"),
    "graph_max_reach": _MAX_REACH,
    "sssp_cost": _SSSP,
    "sssp_buckets": _SSSP,
    "sssp_cost_fractional": f"SELECT id, dist / 8.0::DOUBLE AS dist FROM ({_SSSP})",
    "sssp_path": _PATHS,
    "pagerank_all": _PAGERANK,
    "pagerank_top": f"SELECT * FROM ({_PAGERANK}) ORDER BY pagerank DESC, id LIMIT 10",
    "pagerank_sweep": _SWEEP,
    "tbox_triples": _ctes(*_KG, _TBOX, body=f"""SELECT t.s, t.p, t.o, t.o_is_literal, coalesce(n, 0) AS n FROM tbox t LEFT JOIN (
        SELECT CASE WHEN p = '{RDF_TYPE}' THEN o ELSE p END AS s, count(*) AS n FROM abox GROUP BY 1) u ON u.s = t.s"""),
    "props_of_domain": _ctes(*_KG, _TBOX, _ALL, body=_domains("Author")),
    "props_of_domains": _ctes(*_KG, _TBOX, _ALL, body=_domains("Conference", "Journal")),
    "ntriples_roundtrip": _ctes(*_KG, _TBOX, _ALL, body=_LINE.replace("FROM abox", "FROM triples") + rf"""
        UNION ALL SELECT '<{NS}odd/' || replace(n_name, ' ', '\u0020') || '\u0020a\u003Eb\u000A\u003C\u0022\u005Cé👍> <{RDF_TYPE}> <{NS}\u007Bx\u007D> .' FROM nation"""),
    "abox_from_csv": _ctes(*_KG, body="SELECT s, p, o, o_is_literal FROM abox"),
    "abox_triples": _ctes(*_KG, body="SELECT s, p, o, o_is_literal FROM abox"),
    "author_titles": _ctes(*_KG, _TBOX, _ALL, body=_NAMED_TITLES.format(more="")),
    "author_titles_by_keyword": _ctes(*_KG, _TBOX, _ALL, body=_NAMED_TITLES.format(more=_BY_KEYWORD)),
    "author_titles_encoded": _ctes(*_KG, _TBOX, _ALL, body=_NAMED_TITLES.format(more="")),
    "author_titles_encoded_by_keyword": _ctes(*_KG, _TBOX, _ALL, body=_NAMED_TITLES.format(more=_BY_KEYWORD)),
}
