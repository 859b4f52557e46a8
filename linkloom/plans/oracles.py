"""The named queries as DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from linkloom.plans.catalog import ARRIVALS, BEST_FIRST, CRAWL_DEPTH, DEQUEUED, ROUNDS, SPAM_HOSTS, TOP_K, WAVES
from linkloom.plans.corpora import EXTRA_ANCHORS, KEYS_PER_PAGE, SHOP, SHOP_EXTRA, UNREAD

# What a URL may not hold.
HOSTS = ("malicious", "porn", "hack", "onion")
EXTENSIONS = ("jpg", "png", "gif", "exe", "zip", "pdf")


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def one_of(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(map(text, values)) + ")"


# URL expressions.


def scheme(url: str) -> str:
    return f"lower(regexp_extract({url}, '^([^:/?#]+):', 1))"


def authority(url: str) -> str:
    return f"regexp_extract({url}, '^[^:/?#]+://([^/?#]*)', 1)"


def host(url: str) -> str:
    return f"regexp_replace(regexp_replace({authority(url)}, '^[^@]*@', ''), ':.*$', '')"


def path(url: str) -> str:
    return f"regexp_extract({url}, '^[^:/?#]+:(?://[^/?#]*)?([^?#]*)', 1)"


def can_parse(url: str) -> str:
    # The pattern is a fixed value.
    return (
        f"(NOT regexp_full_match({path(url)}, '([/-_\\w~]*/)?([-_\\w]*)?(\\.(\\w*))?')"
        f" OR NOT contains({path(url)}, '.') OR regexp_matches({path(url)}, '\\.html?$'))"
    )


def reason(url: str, hosts: tuple[str, ...] = HOSTS, extensions: tuple[str, ...] = EXTENSIONS) -> str:
    words = " OR ".join(f"contains({host(url)}, {text(word)})" for word in hosts)
    last = f"lower(list_last(string_split(rtrim({path(url)}, '.'), '.')))"
    return (
        f"CASE WHEN {scheme(url)} NOT IN ('http', 'https') THEN 'unsupported_protocol'"
        f" WHEN {words} THEN 'blocked_host'"
        f" WHEN {last} IN {one_of(extensions)} THEN 'blocked_extension' END"
    )


def priority(url: str) -> str:
    return (
        f"CAST(CASE WHEN {scheme(url)} = 'https' THEN 0 ELSE 10 END + least(length({url}) // 100, 5)"
        f" + length({path(url)}) - length(replace({path(url)}, '/', '')) AS INTEGER)"
    )


# Page sources.

PLAIN = "SELECT page_id, url, html FROM pages"
MIXED = (
    f"SELECT page_id, url, CASE WHEN NOT suffix(url, {text(UNREAD)}) THEN html"
    + "".join(
        f" || CASE WHEN contains(url, {text(marker)}) THEN {text(anchor)} ELSE '' END"
        for marker, anchor in EXTRA_ANCHORS
    )
    + """ || '<a href="' || replace(url, '&', '&amp;') || '">self</a>' END AS html FROM pages"""
)
SHOP_PAGES = f"""
SELECT 0 AS page_id, '{SHOP}/' || kind || '/' || key AS url,
       '<html><body>' || string_agg('<a href="/' || to_kind || '/' || to_key || '">x</a>', '' ORDER BY to_kind, to_key)
       || {text(SHOP_EXTRA + "</body></html>")} AS html
FROM (
  SELECT 'region' AS kind, n_regionkey AS key, 'nation' AS to_kind, n_nationkey AS to_key FROM nation
  UNION ALL SELECT 'nation', n_nationkey, 'region', n_regionkey FROM nation
  UNION ALL SELECT 'nation', c_nationkey, 'customer', c_custkey FROM customer
  UNION ALL SELECT 'customer', c_custkey, 'nation', c_nationkey FROM customer
  UNION ALL SELECT 'customer', o_custkey, 'order', o_orderkey FROM orders
  UNION ALL SELECT 'order', o_orderkey, 'customer', o_custkey FROM orders
) AS neighbours
GROUP BY kind, key, to_key // {KEYS_PER_PAGE}"""
# Whole tokens of a page: comments, scripts and styles with what they hold, start tags with their attributes.
ATTRIBUTES = r"""(?:[\s/]+|[^\s/>="']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?)*"""
TOKEN = (
    rf"(?is)<!--.*?-->|<script(?:[\s/]{ATTRIBUTES})?>.*?</script\s*>|<style(?:[\s/]{ATTRIBUTES})?>.*?</style\s*>"
    rf"|<[a-z][^\s/>]*{ATTRIBUTES}>"
)
ANCHOR = (
    r"""(?is)^<a[\s/](?:[\s/]+|[^\s/>="']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?[\s/])*?"""
    r"""href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
)
# References that the corpora hold.
REFERENCES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&#0000000038;", "&"),
    ("&#x0000002F;", "/"),
    ("&eacute;", "é"),
    ("&copy;", "©"),
    ("&amp;", "&"),
)


def found(source: str, failing: str | None = None) -> str:
    """CTEs ending in ``found``: every link with its outcome; ``kept``: the survivors.

    ``failing`` is the condition under which a link fails its page.
    """
    bare = """CASE WHEN raw[1] IN ('"', '''') THEN raw[2:length(raw) - 1] ELSE raw END"""
    for reference, character in REFERENCES:
        bare = f"replace({bare}, {text(reference)}, {text(character)})"
    failing = "false" if failing is None else failing
    return f"""
given AS ({source}),
raws AS (SELECT page_id, url, list_filter(list_transform(
           list_filter(regexp_extract_all(html, {text(TOKEN)}), lambda t: regexp_matches(t, '(?i)^<a[\\s/]')),
           lambda t: regexp_extract(t, {text(ANCHOR)}, 1)), lambda r: r <> '') AS raws
         FROM given),
hrefs AS (SELECT page_id, url AS src, CAST(pos - 1 AS INTEGER) AS pos, {bare} AS href
          FROM (SELECT page_id, url, unnest(raws) AS raw, generate_subscripts(raws, 1) AS pos FROM raws) AS u),
judged AS (SELECT *, CASE WHEN regexp_matches(href, '^(?i)(mailto|ftp):') THEN 'protocol'
                          WHEN regexp_matches(href, '^(?i)javascript:') THEN 'malformed' END AS error_class
           FROM hrefs
           UNION ALL SELECT page_id, url, 0, NULL, 'other' FROM given WHERE html IS NULL),
found AS (SELECT *, CASE
            WHEN error_class IS NOT NULL THEN NULL
            WHEN regexp_matches(href, '^(?i)https?://') THEN {scheme("href")} || substr(href, strpos(href, ':'))
            WHEN starts_with(href, '//') THEN {scheme("src")} || ':' || href
            WHEN starts_with(href, '/') THEN {scheme("src")} || '://' || {authority("src")} || href
            ELSE {scheme("src")} || '://' || {authority("src")} || regexp_extract({path("src")}, '^(.*/)', 1) || href
          END AS dst FROM judged),
failed AS (SELECT DISTINCT page_id FROM found WHERE {failing}),
kept AS (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INTEGER) AS pos, src, href, dst
         FROM found WHERE error_class IS NULL AND page_id NOT IN (SELECT page_id FROM failed))"""


FAILS_STRICT = "error_class IS NOT NULL"
FAILS_FORGIVE = "error_class IS NOT NULL AND error_class <> 'protocol'"
FAILS_PLUGGED = "error_class IS NOT NULL AND error_class <> 'malformed'"


def over(source: str, select: str, failing: str | None = None, more: str = "") -> str:
    return f"WITH {found(source, failing)}{more} {select}"


EVERY_URL = ", every AS (SELECT src AS url FROM kept UNION SELECT dst FROM kept)"
ADMITTED = f", admitted AS (SELECT * FROM kept WHERE {reason('dst')} IS NULL)"
FRONTIER = ADMITTED + f", frontier AS (SELECT DISTINCT dst AS url, {priority('dst')} AS priority FROM admitted)"
BATCHED = f", batched AS (SELECT *, {host('src')} AS batch FROM found)"
ENDS = ", ends AS (SELECT src AS url FROM kept UNION SELECT dst FROM kept)"


# Crawls over the shop, unrolled wave by wave.


def shop_links(ignored: str) -> str:
    return found(SHOP_PAGES) + (
        f", links AS MATERIALIZED (SELECT DISTINCT src, dst FROM kept"
        f" WHERE {can_parse('src')} AND ({ignored}) IS NULL)"
        f", seeds AS (SELECT '{SHOP}/region/' || r_regionkey AS url FROM region)"
    )


def levels(depth: int, score: str = priority("url"), ignored: str = reason("dst")) -> str:
    """CTEs ending in ``crawled(url, depth)``."""
    parts = [shop_links(ignored), ", level0 AS MATERIALIZED (SELECT DISTINCT url, 0 AS depth FROM seeds)"]
    for d in range(1, depth + 1):
        earlier = " UNION ALL ".join(f"SELECT url FROM level{i}" for i in range(d))
        parts.append(
            f", level{d} AS MATERIALIZED (SELECT DISTINCT dst AS url, {d} AS depth FROM links"
            f" JOIN level{d - 1} ON src = url WHERE dst NOT IN ({earlier}))"
        )
    union = " UNION ALL ".join(f"SELECT url, depth FROM level{i}" for i in range(depth + 1))
    parts.append(f", crawled AS (SELECT url, depth, {score} AS priority, depth AS wave FROM ({union}) AS l)")
    return "WITH " + "".join(parts)


def waves(sizes: list[int], max_depth: int | None, budget: int | None = None) -> str:
    """CTEs ``wave<i>`` and ``pending<i>`` for waves of the given sizes."""
    parts = [
        shop_links(reason("dst")),
        f", pending0 AS MATERIALIZED (SELECT DISTINCT url, {priority('url')} AS priority, 0 AS depth FROM seeds)",
    ]
    for i, size in enumerate(sizes):
        earlier = " UNION ALL ".join(f"SELECT url FROM wave{j}" for j in range(i)) or "SELECT '' AS url WHERE false"
        visited = " UNION ALL ".join(f"SELECT url FROM wave{j}" for j in range(i + 1))
        limit = "" if max_depth is None else f" AND depth < {max_depth}"
        room = str(size) if budget is None else f"least({size}, {budget} - (SELECT count(*) FROM ({earlier}) AS v))"
        parts.append(
            f", wave{i} AS MATERIALIZED (SELECT url, priority, depth FROM"
            f" (SELECT *, row_number() OVER (ORDER BY priority, url) AS place FROM pending{i}) AS q WHERE place <= {room})"
            f", pending{i + 1} AS MATERIALIZED (SELECT url, {priority('url')} AS priority, CAST(min(depth) AS INTEGER) AS depth"
            f" FROM (SELECT url, depth FROM pending{i}"
            f" UNION ALL SELECT dst, depth + 1 FROM links JOIN wave{i} ON src = url{limit}) AS p"
            f" WHERE url NOT IN ({visited}) GROUP BY url)"
        )
    return "WITH " + "".join(parts)


# More waves than the page budget can need; the surplus ones are empty.
BEST_FIRST_WAVES = 12


def best_first() -> str:
    sizes = [BEST_FIRST["wave_size"]] * BEST_FIRST_WAVES
    union = " UNION ALL ".join(
        f"SELECT url, depth, priority, {i} AS wave FROM wave{i}" for i in range(len(sizes))
    )
    return f"{waves(sizes, BEST_FIRST['max_depth'], BEST_FIRST['max_pages'])} {union}"


# PageRank.

HOPS = """SELECT CAST(user_id AS VARCHAR) AS src, CAST(next_id AS VARCHAR) AS dst FROM (
  SELECT user_id, lead(user_id) OVER (ORDER BY ts, event_id) AS next_id FROM events) AS e WHERE next_id IS NOT NULL"""
PARTS = """SELECT src, dst FROM (SELECT DISTINCT 'o' || l_orderkey AS o, 'p' || l_partkey AS p FROM lineitem) AS l,
  LATERAL (SELECT o AS src, p AS dst UNION ALL SELECT p, o) AS both_ways"""


def weights(edges: str) -> str:
    return f"""edges AS MATERIALIZED ({edges}),
ids AS MATERIALIZED (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
outs AS (SELECT src, count(*) AS n FROM edges GROUP BY src),
weights AS MATERIALIZED (SELECT e.src, e.dst, count(*) / any_value(o.n) AS w
                         FROM edges AS e JOIN outs AS o ON e.src = o.src GROUP BY e.src, e.dst)"""


def rounds(edges: str, name: str = "id") -> str:
    """Fixed number of iterations, unrolled."""
    steps = [", r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM ids)"]
    for k in range(1, ROUNDS + 1):
        steps.append(
            f", r{k} AS MATERIALIZED (SELECT ids.id, 0.15 + 0.85 * coalesce(m.message, 0) AS rank FROM ids LEFT JOIN"
            f" (SELECT w.dst, sum(r.rank * w.w) AS message FROM weights AS w JOIN r{k - 1} AS r ON r.id = w.src"
            f" GROUP BY w.dst) AS m ON m.dst = ids.id)"
        )
    return f"WITH {weights(edges)}{''.join(steps)} {scaled(f'r{ROUNDS}', name)}"


def scaled(ranks: str, name: str = "id") -> str:
    return (
        f"SELECT id AS {name}, round(rank * (SELECT count(*) / sum(rank) FROM {ranks}), 4) AS rank FROM {ranks}"
    )


def converged(edges: str, name: str = "id", tol: str = "0.0001") -> str:
    """Changes above the tolerance are passed on until there are none."""
    return f"""WITH RECURSIVE {weights(edges)},
run AS (
  SELECT 0 AS k, id, 0.15::DOUBLE AS rank, 0.15::DOUBLE AS delta FROM ids
  UNION ALL
  SELECT cur.k + 1, cur.id, cur.rank + 0.85 * coalesce(m.message, 0), 0.85 * coalesce(m.message, 0)
  FROM run AS cur LEFT JOIN (
    SELECT w.dst, sum(p.delta * w.w) AS message FROM run AS p JOIN weights AS w ON w.src = p.id
    WHERE p.delta > {tol} GROUP BY w.dst) AS m ON m.dst = cur.id
  WHERE EXISTS (SELECT 1 FROM run AS q JOIN outs ON outs.src = q.id WHERE q.delta > {tol})
),
final AS (SELECT id, rank FROM run WHERE k = (SELECT max(k) FROM run)) {scaled('final', name)}"""


PAGE_EDGES = over(PLAIN, "SELECT src, dst FROM kept")
DEBT = """WITH nodes AS (
  SELECT c_custkey AS id, c_name AS url FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT -1 - o_orderkey, 'order-' || o_orderkey FROM orders WHERE o_orderstatus = 'O'),
debt AS (SELECT o_custkey AS src, -1 - o_orderkey AS dst, 'link' AS type FROM orders)"""
CRAWLED = (
    f", visited AS MATERIALIZED (SELECT src, dst FROM kept WHERE {can_parse('src')} AND {reason('dst')} IS NULL"
    " AND src IN (SELECT url FROM crawled))"
)
LOOPED = """, last AS (SELECT page_id, dst, CAST(max(pos) AS BIGINT) AS id FROM kept GROUP BY page_id, dst),
page_edges AS (SELECT k.page_id, s.id AS src, t.id AS dst, 'link' AS type FROM kept AS k
  JOIN last AS s ON s.page_id = k.page_id AND s.dst = k.src
  JOIN last AS t ON t.page_id = k.page_id AND t.dst = k.dst)"""
PAIRS = "SELECT src, dst, count(*) AS edges FROM kept GROUP BY src, dst"
IN_DEGREE = "SELECT dst AS url, count(*) AS in_degree FROM admitted GROUP BY dst"
GRAPH_COUNTS = "(SELECT count(*) FROM ends) AS {0}, (SELECT count(*) FROM kept) AS edges"
EACH_EDGE = "SELECT src AS src_url, dst AS dst_url, 'link' AS type FROM kept"
FOUR = "SELECT page_id, pos, src, dst FROM kept"


def verdicts(failing: str) -> str:
    first = "(SELECT page_id, arg_min(error_class, pos) AS error_class FROM found WHERE {0} GROUP BY page_id)"
    return over(
        MIXED,
        f"SELECT g.page_id, f.error_class FROM given AS g LEFT JOIN {first.format(failing)} AS f ON f.page_id = g.page_id",
    )


def oracle_queries() -> dict[str, str]:
    return {
        "top_linked": over(PLAIN, f"{IN_DEGREE} ORDER BY in_degree DESC, url LIMIT {TOP_K}", more=ADMITTED),
        "page_text": "SELECT page_id, url, md5(html) AS html_md5 FROM pages",
        "page_hrefs": over(MIXED, "SELECT page_id, pos, href FROM found"),
        "link_outcomes": over(MIXED, "SELECT page_id, pos, dst, error_class FROM found"),
        "links": over(PLAIN, FOUR),
        "link_positions": over(MIXED, "SELECT page_id, pos, dst FROM kept"),
        "links_strict": over(MIXED, FOUR, FAILS_STRICT),
        "links_forgive": over(MIXED, FOUR, FAILS_FORGIVE),
        "links_forgive_pluggable": over(MIXED, FOUR, FAILS_PLUGGED),
        "links_batch": over(
            MIXED,
            "SELECT batch, page_id, pos, dst FROM batched WHERE error_class IS NULL"
            f" AND batch NOT IN (SELECT batch FROM batched WHERE {FAILS_FORGIVE})",
            more=BATCHED,
        ),
        "batch_failures": over(
            MIXED,
            f"SELECT batch, arg_min(error_class, (page_id, pos)) AS error_class FROM batched WHERE {FAILS_STRICT}"
            " GROUP BY batch",
            more=BATCHED,
        ),
        "page_verdicts": verdicts(FAILS_STRICT),
        "page_verdicts_forgive": verdicts(FAILS_FORGIVE),
        "link_errors": over(MIXED, f"SELECT page_id, pos, href, error_class FROM found WHERE {FAILS_STRICT}"),
        "error_counts": over(
            MIXED, f"SELECT error_class, count(*) AS failures FROM found WHERE {FAILS_STRICT} GROUP BY error_class"
        ),
        "collect_policies": over(
            MIXED,
            "SELECT g.page_id, CASE WHEN count(f.page_id) = count(f.dst) THEN coalesce(string_agg(f.dst, '|' ORDER BY f.pos), '')"
            " END AS all_or_null, coalesce(string_agg(f.dst, '|' ORDER BY f.pos), '') AS present_only"
            " FROM given AS g LEFT JOIN found AS f ON f.page_id = g.page_id GROUP BY g.page_id",
        ),
        "links_per_page": over(
            MIXED,
            "SELECT g.page_id, count(k.page_id) AS links FROM given AS g LEFT JOIN kept AS k ON k.page_id = g.page_id"
            " GROUP BY g.page_id",
            FAILS_FORGIVE,
        ),
        "seed_policy": over(
            MIXED,
            "SELECT policy, (SELECT count(*) FROM texts WHERE read AND (policy <> 'strict'"
            " OR (SELECT bool_and(read) FROM texts))) AS seeds"
            " FROM (VALUES ('strict'), ('forgive'), ('lax')) AS p(policy)",
            more=", texts AS (SELECT DISTINCT href,"
            " regexp_matches(href, '^(?i)(https?|ftp|mailto):') AS read FROM found)",
        ),
        "parse_gate": over(
            MIXED,
            "SELECT batch, url FROM hosts WHERE batch IN (SELECT batch FROM hosts WHERE parses)",
            more=EVERY_URL + f", hosts AS (SELECT url, {host('url')} AS batch, {can_parse('url')} AS parses FROM every)",
        ),
        "url_parts": over(
            MIXED,
            f"SELECT {scheme('url')} AS scheme, {host('url')} AS host, {path('url')} AS path, url AS text FROM every",
            more=EVERY_URL,
        ),
        "can_parse": over(MIXED, f"SELECT url, {can_parse('url')} AS can_parse FROM every", more=EVERY_URL),
        "ignored_urls": over(MIXED, f"SELECT url, {reason('url')} AS ignore_reason FROM every", more=EVERY_URL),
        "ignore_reasons": over(
            MIXED,
            f"SELECT {reason('url', SPAM_HOSTS, ('zip', 'html'))} AS ignore_reason, count(*) AS urls FROM every GROUP BY 1",
            more=EVERY_URL,
        ),
        "admitted_links": over(
            MIXED, f"SELECT page_id, pos, dst FROM kept WHERE {reason('dst', SPAM_HOSTS)} IS NULL"
        ),
        "url_priority": over(MIXED, f"SELECT url, {priority('url')} AS priority FROM every", more=EVERY_URL),
        "display_labels": over(
            MIXED,
            "SELECT url, CASE WHEN length(url) > 30 THEN substr(url, 1, 27) || '...' ELSE url END AS label FROM every",
            more=EVERY_URL,
        ),
        "queue_order": over(
            PLAIN,
            "SELECT row_number() OVER (ORDER BY priority, url) - 1 AS position, url, priority FROM frontier",
            more=FRONTIER,
        ),
        "dequeue_n": over(
            PLAIN, f"SELECT url, priority FROM frontier ORDER BY priority, url LIMIT {DEQUEUED}", more=FRONTIER
        ),
        "dequeue_rest": over(
            PLAIN, f"SELECT url, priority FROM frontier ORDER BY priority, url OFFSET {DEQUEUED}", more=FRONTIER
        ),
        "queue_size": over(PLAIN, "SELECT count(*) AS queue_size FROM frontier", more=FRONTIER),
        "in_degree": over(PLAIN, IN_DEGREE, more=ADMITTED),
        "in_degree_crawled": levels(1)
        + f"{CRAWLED} SELECT dst AS url, count(*) AS in_degree FROM visited GROUP BY dst",
        "crawl_report": levels(1)
        + f"{CRAWLED} SELECT arg_min(url, (-n, url)) AS top_url, max(n) AS top_in_degree, count(*) AS crawl_size,"
        " (SELECT count(*) FROM (SELECT src FROM visited UNION SELECT dst FROM visited)) AS vertices,"
        " (SELECT count(*) FROM visited) AS edges FROM (SELECT dst AS url, count(*) AS n FROM visited GROUP BY dst)",
        "crawl_ranks": rounds(f"SELECT src, dst FROM ({levels(1)}{CRAWLED} SELECT src, dst FROM visited)", "url"),
        "crawl_stored": levels(1) + f"{CRAWLED} SELECT src AS src_url, dst AS dst_url, 'link' AS type FROM visited",
        "stream_batches": f"SELECT {ARRIVALS}::BIGINT AS batches",
        "crawl_size": over(PLAIN, "SELECT count(DISTINCT dst) AS crawl_size FROM admitted", more=ADMITTED),
        "page_vertices": over(MIXED, "SELECT page_id, CAST(pos AS BIGINT) AS id, dst AS url FROM kept"),
        "page_edges": over(MIXED, "SELECT page_id, src, dst, type FROM page_edges", more=LOOPED),
        "global_vertices": over(
            PLAIN, "SELECT url, 1::BIGINT AS vertices, 1::BIGINT AS ids FROM ends", more=ENDS
        ),
        "global_edges": over(PLAIN, EACH_EDGE),
        "edges_by_url": over(MIXED, f"{EACH_EDGE} WHERE src IN (SELECT dst FROM kept)"),
        "property_graph": over(
            MIXED,
            "SELECT id, min(url) AS url FROM (SELECT CAST(pos AS BIGINT) AS id, dst AS url FROM kept"
            " UNION ALL SELECT src, NULL FROM page_edges UNION ALL SELECT dst, NULL FROM page_edges) AS v GROUP BY id",
            more=LOOPED,
        ),
        "resolved_edges": DEBT
        + " SELECT d.src, d.dst, s.url AS src_url, t.url AS dst_url, d.type FROM debt AS d"
        " JOIN nodes AS s ON s.id = d.src JOIN nodes AS t ON t.id = d.dst",
        "labelled_edges": DEBT
        + " SELECT coalesce(s.url, 'unknown-' || d.src) AS src_label, coalesce(t.url, 'unknown-' || d.dst) AS dst_label,"
        " d.type FROM debt AS d LEFT JOIN nodes AS s ON s.id = d.src LEFT JOIN nodes AS t ON t.id = d.dst",
        "appended_links": "SELECT src, dst, count(*) AS links FROM ("
        f"({over(PLAIN, 'SELECT src, dst FROM kept')}) UNION ALL ({over(MIXED, 'SELECT src, dst FROM kept')})"
        ") AS both_links GROUP BY src, dst",
        "graph_stats": over(PLAIN, f"SELECT {GRAPH_COUNTS.format('vertices')}", more=ENDS),
        "crawl_summary": over(
            PLAIN,
            "SELECT url AS top_url, in_degree AS top_in_degree, (SELECT count(DISTINCT dst) FROM admitted) AS crawl_size,"
            f" {GRAPH_COUNTS.format('vertices')} FROM ({IN_DEGREE}) AS d ORDER BY in_degree DESC, url LIMIT 1",
            more=ADMITTED + ENDS,
        ),
        "frontier_seed": f"SELECT DISTINCT url, {priority('url')} AS priority, 0 AS depth FROM pages"
        f" WHERE {reason('url')} IS NULL",
        "unvisited_targets": over(
            MIXED, "SELECT DISTINCT dst AS url FROM kept WHERE dst NOT IN (SELECT url FROM pages)"
        ),
        "fetched": over(
            MIXED,
            "SELECT e.url, md5(p.html) AS html_md5, CASE WHEN p.url IS NULL THEN 'not_found' END AS error_class"
            " FROM every AS e LEFT JOIN pages AS p ON p.url = e.url",
            more=EVERY_URL,
        ),
        "frontier_wave": f"{waves(list(WAVES), None)} SELECT url, priority, depth FROM pending{len(WAVES)}",
        "crawl_levels": f"{levels(CRAWL_DEPTH)} SELECT url, depth, priority, wave FROM crawled",
        "crawl_best_first": best_first(),
        "crawl_custom_heuristics": levels(
            CRAWL_DEPTH,
            "CAST(CASE WHEN contains(url, '/nation/') THEN 0 ELSE length(url) END AS INTEGER)",
            "CASE WHEN contains(dst, '/order/') THEN 'order' END",
        )
        + " SELECT url, depth, priority, wave FROM crawled",
        "crawl_constant_heuristics": levels(CRAWL_DEPTH, "0", "NULL") + " SELECT url, depth, priority, wave FROM crawled",
        "pagerank_fixed": rounds(HOPS),
        "pagerank_converged": converged(HOPS),
        "pagerank_parts": rounds(PARTS),
        "pagerank_links": converged(PAGE_EDGES, "url"),
        "graph_roundtrip": over(PLAIN, f"SELECT {GRAPH_COUNTS.format('nodes')}", more=ENDS),
        "stored_nodes": over(PLAIN, "SELECT url FROM ends", more=ENDS),
        "stored_relations": over(PLAIN, EACH_EDGE),
        "stream_links": over(PLAIN, FOUR, FAILS_STRICT),
        "stream_in_degree": over(PLAIN, IN_DEGREE, more=ADMITTED),
        "stream_first_seen": over(PLAIN, "SELECT DISTINCT dst AS url FROM kept"),
        "stream_edges": over(PLAIN, PAIRS),
        "stream_sizes": over(
            PLAIN,
            "SELECT (SELECT count(*) FROM given) AS pages, (SELECT count(*) FROM kept) AS vertices,"
            " (SELECT count(*) FROM page_edges) AS edges, (SELECT count(*) FROM admitted) AS queued",
            more=LOOPED + ADMITTED,
        ),
    }
