"""The operator inventory over the driver's tables: each query with the DuckDB SQL for the same result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import text as T
from seqloom.operators import relational as R
from seqloom.operators.shuffle import cut, dealt_join
from seqloom.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


def _cell():
    return F.concat(F.lit("GO:"), F.col("l_partkey").cast("string"), F.lit("^"), "p_type", F.lit("^"), "p_name")


@query("""SELECT name, n FROM (SELECT upper(p_name) AS name, count(*) AS n FROM
 (SELECT DISTINCT l_orderkey, l_partkey, p_type, p_name FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE upper(p_type) = (SELECT min(upper(p_type)) FROM part)
 GROUP BY 1) ORDER BY n DESC, name DESC LIMIT 15""")
def q_go_topk(s, d):
    """The commonest names among the distinct terms of one name space."""
    part = table(s, d, "part").select("p_partkey", T.upper_ascii(F.col("p_type")).alias("space"), T.upper_ascii(F.col("p_name")).alias("name"))
    first = part.agg(F.min("space").alias("_f"))
    terms = part.join(F.broadcast(first), F.col("space") == F.col("_f"))  # the dimension is filtered before the terms meet it
    uses = table(s, d, "lineitem").select("l_orderkey", "l_partkey").join(terms, F.col("l_partkey") == F.col("p_partkey"), "inner").select("l_orderkey", "l_partkey", "name").distinct()
    return R.top_k(uses, "name", 15)


@query("""SELECT name, n FROM (SELECT upper(p_name) AS name, count(*) AS n FROM
 (SELECT DISTINCT l_orderkey, l_partkey, p_type, p_name FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE upper(p_type) = (SELECT min(upper(p_type)) FROM part)
 GROUP BY 1) ORDER BY n DESC, name DESC LIMIT 15""")
def q_go_shred(s, d):
    """The same from multi-valued cells, one a row, taken apart again."""
    part = table(s, d, "part")
    cells = table(s, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.array_join(F.sort_array(F.collect_list(_cell())), T.ENTRY).alias("cell"))
    terms = cells.select(F.explode(T.go_terms([F.col("cell")])).alias("t")).select(F.split_part("t", F.lit("^"), F.lit(2)).alias("space"), T.upper_ascii(F.split_part("t", F.lit("^"), F.lit(3))).alias("name"))
    first = part.agg(F.min(T.upper_ascii(F.col("p_type"))).alias("_f"))
    return R.top_k(terms.join(F.broadcast(first), T.upper_ascii(F.col("space")) == F.col("_f")), "name", 15)


@query("SELECT count(*)::BIGINT AS total, count_if(lang='en')::BIGINT AS en, count_if(lang='fr')::BIGINT AS fr, count_if(lang='de')::BIGINT AS de, count_if(lang='es')::BIGINT AS es FROM documents")
def q_counts_by_class(s, d):
    return table(s, d, "documents").agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("lang") == x).alias(x) for x in ("en", "fr", "de", "es")])


@query("""SELECT lang, unnest(['before','after']) AS stage, unnest([b, a])::BIGINT AS n FROM (SELECT lang, count(*) AS b, count(DISTINCT text) AS a FROM documents GROUP BY lang)""")
def q_before_after(s, d):
    per = table(s, d, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("before"), F.count_distinct(F.sha2(F.col("text").cast("binary"), 256)).alias("after"))
    return per.unpivot("lang", ["before", "after"], "stage", "n")


_ORF = "count_if(l_returnflag='{0}')::BIGINT AS n_{0}, count_if(l_returnflag='{0}' AND l_linestatus='O')::BIGINT AS annotated_{0}"


@query("SELECT count(*)::BIGINT AS total, count_if(l_linestatus='O')::BIGINT AS annotated, " + ", ".join(_ORF.format(x) for x in "ANR") + " FROM lineitem")
def q_orf_stats(s, d):
    t, a = F.col("l_returnflag"), F.col("l_linestatus") == "O"
    each = [e for x in "ANR" for e in (F.count_if(t == x).alias(f"n_{x}"), F.count_if((t == x) & a).alias(f"annotated_{x}"))]
    return table(s, d, "lineitem").agg(F.count(F.lit(1)).alias("total"), F.count_if(a).alias("annotated"), *each)


@query("""SELECT count(*)::BIGINT AS total, count_if(c=1)::BIGINT AS single, count_if(c>1)::BIGINT AS multi, sum(c)::BIGINT AS terms, (SELECT count(DISTINCT l_partkey) FROM lineitem)::BIGINT AS distinct_terms
 FROM (SELECT l_orderkey, count(DISTINCT l_partkey) AS c FROM lineitem GROUP BY 1)""")
def q_term_summary(s, d):
    li = table(s, d, "lineitem").select("l_orderkey", "l_partkey").distinct()
    per = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("c")).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("c") == 1).alias("single"), F.count_if(F.col("c") > 1).alias("multi"), F.sum("c").alias("terms"))
    return per.join(F.broadcast(li.agg(F.count_distinct("l_partkey").alias("distinct_terms"))), F.lit(True))


@query("""SELECT name, count(*) AS n FROM (SELECT n_name AS name FROM customer JOIN nation ON c_nationkey=n_nationkey UNION ALL SELECT n_name FROM supplier JOIN nation ON s_nationkey=n_nationkey) GROUP BY 1 ORDER BY n DESC, name DESC LIMIT 20""")
def q_union_topk(s, d):
    both = table(s, d, "customer").select(F.col("c_nationkey").alias("k")).unionAll(table(s, d, "supplier").select(F.col("s_nationkey").alias("k")))
    return R.top_k(both.join(table(s, d, "nation"), F.col("k") == F.col("n_nationkey")).select(F.col("n_name").alias("name")), "name", 20)


@query("""WITH k AS (SELECT p_partkey, p_name || '|' || p_brand AS key, p_type FROM part), u AS (SELECT key, any_value(p_type) AS t FROM k GROUP BY 1 HAVING count(*)=1)
 SELECT p_partkey, k.key, coalesce(t, k.key) AS label FROM k LEFT JOIN u ON k.key=u.key""")
def q_lookup_unique(s, d):
    p = table(s, d, "part").select("p_partkey", F.concat_ws("|", "p_name", "p_brand").alias("key"), "p_type")
    return R.lookup_unique(p.drop("p_type"), p, "key", "p_type").select("p_partkey", "key", "label")


@query("SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY l_partkey) AS items FROM lineitem GROUP BY 1 HAVING count(*)=5")
def q_group_exact_n(s, d):
    return R.group_exact_n(table(s, d, "lineitem"), "l_orderkey", F.col("l_partkey"), 5).select("l_orderkey", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))


@query("SELECT o_orderkey AS key, o_orderstatus, n FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey=l_orderkey")
def q_channel_join(s, d):
    agg = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return R.channel_join(table(s, d, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus"), agg, "key")


@query("SELECT page_id, unnest(string_split(split_part(split_part(url,'#',1),'?',2),'&')) AS param FROM pages WHERE contains(split_part(url,'#',1),'?')")
def q_flatten(s, d):
    bare = F.split_part("url", F.lit("#"), F.lit(1))
    return table(s, d, "pages").where(bare.contains("?")).select("page_id", F.explode(F.split(F.split_part(bare, F.lit("?"), F.lit(2)), "&")).alias("param"))


@query("SELECT * FROM (VALUES ('s1','a_R1.fq','a_R2.fq'),('s2','b_R1.fq','b_R2.fq')) t(sample_id, r1, r2)")
def q_inline_rows(s, d):
    return R.require_rows(s.sql("SELECT * FROM VALUES ('s1','a_R1.fq','a_R2.fq'),('s2','b_R1.fq','b_R2.fq') AS t(sample_id, r1, r2)"))


@query("SELECT conv_id, (turn // 2)::BIGINT AS pair FROM conversations GROUP BY 1, 2 HAVING count(*)=2")
def q_file_pairs(s, d):
    return table(s, d, "conversations").groupBy("conv_id", F.floor(F.col("turn") / 2).alias("pair")).agg(F.count(F.lit(1)).alias("n")).where("n = 2").drop("n")


@query("SELECT o_orderkey, 'not run' AS note FROM orders")
def q_placeholder(s, d):
    none = s.createDataFrame([], "o_orderkey bigint, note string")
    return table(s, d, "orders").select("o_orderkey").join(none, "o_orderkey", "left").select("o_orderkey", F.coalesce("note", F.lit("not run")).alias("note"))


@query("SELECT 'customer' AS tag, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part")
def q_union_tagged(s, d):
    frames = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
    return R.union_tagged({t: table(s, d, t).select(F.col(k).alias("id")) for t, k in frames.items()}).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'species1_' || split_part(c_name,' ',1) AS id FROM customer UNION ALL SELECT 'species2_' || split_part(s_name,' ',1) FROM supplier")
def q_prefix_ids(s, d):
    pre = lambda t, c, p: table(s, d, t).select(F.concat(F.lit(p), F.split_part(c, F.lit(" "), F.lit(1))).alias("id"))
    return pre("customer", "c_name", "species1_").unionAll(pre("supplier", "s_name", "species2_"))


@query("SELECT doc_id AS gene, doc_id AS transcript FROM documents")
def q_identity_map(s, d):
    return table(s, d, "documents").select(F.col("doc_id").alias("gene"), F.col("doc_id").alias("transcript"))


@query("SELECT doc_id, length(text)::BIGINT AS length, (length(text)+1)::BIGINT AS size_plus1 FROM documents")
def q_fasta_len(s, d):
    n = F.length("text").cast("long")
    return table(s, d, "documents").select("doc_id", n.alias("length"), (n + 1).alias("size_plus1"))


@query("""SELECT CASE WHEN l<200 THEN 0 WHEN l>=2500 THEN 24 ELSE (l-200)//100+1 END::BIGINT AS bin, count(*) AS n FROM (SELECT length(text) AS l FROM documents) GROUP BY 1""")
def q_histogram(s, d):
    return table(s, d, "documents").groupBy(F.expr("width_bucket(length(text), 200, 2500, 23)").cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id FROM documents WHERE length(text) >= 200")
def q_min_len(s, d):
    return table(s, d, "documents").where(F.length("text") >= 200).select("doc_id")


_BEST = "SELECT l_orderkey, l_partkey, l_extendedprice, l_discount FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber)=1"


@query(f"SELECT o_orderkey, '>' || o_orderkey::VARCHAR || ' Part:' || coalesce(l_partkey::VARCHAR,'noHit') AS header FROM orders LEFT JOIN ({_BEST}) ON o_orderkey=l_orderkey")
def q_nohit_default(s, d):
    best = R.best_per_key(table(s, d, "lineitem"), "l_orderkey", F.desc("l_extendedprice"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"))
    o = table(s, d, "orders").select("o_orderkey").join(best.select("l_orderkey", "l_partkey"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    key = F.col("o_orderkey").cast("string")
    return o.select("o_orderkey", F.concat(F.lit(">"), key, F.lit(" Part:"), T.hit_or_none(F.col("l_partkey").cast("string"))).alias("header"))


@query("""SELECT o_orderkey AS key, coalesce(p,'.') AS parts, coalesce(f,'.') AS flags, coalesce(n_name,'.') AS nation FROM orders
 LEFT JOIN (SELECT l_orderkey, string_agg(l_partkey::VARCHAR,'`' ORDER BY l_partkey::VARCHAR) AS p, string_agg(l_returnflag,'`' ORDER BY l_returnflag) AS f FROM lineitem GROUP BY 1) ON o_orderkey=l_orderkey
 LEFT JOIN customer ON o_custkey=c_custkey LEFT JOIN nation ON c_nationkey=n_nationkey""")
def q_annotation_star(s, d):
    li = table(s, d, "lineitem").withColumnRenamed("l_orderkey", "key")
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("key"), "o_custkey")
    star = R.annotation_star(o, "key", {"parts": (li, "l_partkey"), "flags": (li, "l_returnflag")})
    star = star.join(table(s, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left").join(table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return star.select("key", "parts", "flags", F.coalesce("n_name", F.lit(".")).alias("nation"))


@query("SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem WHERE l_discount <= 0.05 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber)=1")
def q_top1_hit(s, d):
    li = table(s, d, "lineitem").where("l_discount <= 0.05D")
    return R.best_per_key(li, "l_orderkey", F.desc("l_extendedprice"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")).select("l_orderkey", "l_partkey", "l_extendedprice")


@query("SELECT p_brand, string_agg(p_partkey::VARCHAR, ';' ORDER BY p_partkey) AS ids FROM part GROUP BY 1")
def q_split_levels(s, d):
    cell = table(s, d, "part").groupBy("p_brand").agg(F.sort_array(F.collect_list(F.struct("p_partkey", "p_name"))).alias("x"))
    cell = cell.select("p_brand", F.array_join(F.transform("x", lambda e: F.concat_ws("^", e["p_partkey"].cast("string"), e["p_name"])), "`").alias("cell"))
    return cell.select("p_brand", T.split_levels(F.col("cell")).alias("ids"))


@query("SELECT page_id, regexp_extract(url, '[?][^=#]*=([^&#]*)', 1) AS value FROM pages WHERE contains(url,'?')")
def q_first_token(s, d):
    return table(s, d, "pages").where("contains(url, '?')").select("page_id", F.regexp_extract("url", r"[?][^=#]*=([^&#]*)", 1).alias("value"))


@query("""SELECT event_type, sum(k)::BIGINT AS before, sum(CASE WHEN k>=50 THEN k ELSE 0 END)::BIGINT AS after, sum(CASE WHEN k<50 THEN k ELSE 0 END)::BIGINT AS discarded
 FROM (SELECT event_type, (props->>'$.k')::INT AS k FROM events) GROUP BY 1""")
def q_json_extract(s, d):
    e = table(s, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    per = e.groupBy("event_type").agg(F.sum("k").alias("before"), F.sum(F.when(F.col("k") >= 50, F.col("k")).otherwise(0)).alias("after"))
    return per.withColumn("discarded", F.col("before") - F.col("after"))


@query("""SELECT pos::INT AS pos, count(*) AS n, round(avg(v::DOUBLE),4) AS mean FROM (SELECT unnest(embedding) AS v, generate_subscripts(embedding,1)-1 AS pos FROM embeddings) GROUP BY 1""")
def q_curve_explode(s, d):
    return table(s, d, "embeddings").select(F.posexplode("embedding").alias("pos", "v")).groupBy("pos").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.col("v").cast("double")), 4).alias("mean"))


@query("SELECT label, count(*) AS n FROM embeddings WHERE list_sum(list_transform(embedding, lambda x: x::DOUBLE))/len(embedding) > 0 GROUP BY 1")
def q_mean_filter(s, d):
    mean = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")) / F.size("embedding")
    return table(s, d, "embeddings").where(mean > 0).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, split_part(kv,'=',1) AS category, split_part(kv,'=',2) AS value FROM (SELECT page_id, unnest(string_split(split_part(split_part(url,'#',1),'?',2),'&')) AS kv FROM pages) WHERE contains(kv,'=')")
def q_kv_parse(s, d):
    kv = q_flatten(s, d).where("contains(param, '=')")
    return kv.select("page_id", F.split_part("param", F.lit("="), F.lit(1)).alias("category"), F.split_part("param", F.lit("="), F.lit(2)).alias("value"))


@query("SELECT 90.0::DOUBLE AS s, 5.1::DOUBLE AS d, 2.0::DOUBLE AS f, 2.9::DOUBLE AS m UNION ALL SELECT 100.0, 0.0, 0.0, 0.0")
def q_regex_summary(s, d):
    lines = s.sql("SELECT * FROM VALUES ('C:95.1%[S:90.0%,D:5.1%],F:2.0%,M:2.9%,n:954'), ('C:100.0%[S:100.0%,D:0.0%],F:0.0%,M:0.0%,n:5') AS t(line)")
    return lines.select(*[T.busco_percent(F.col("line"), x.upper()).alias(x) for x in "sdfm"])


_CELLS = """(SELECT u.user_id, t.day, CASE WHEN n IS NULL THEN 'Missing' WHEN p=n THEN 'Fragmented' WHEN n>1 THEN 'Duplicated' ELSE 'Complete' END AS status
 FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN (SELECT unnest(range(1,31))::INT AS day) t
 LEFT JOIN (SELECT user_id, day(ts)::INT AS day, count(*) AS n, count_if(event_type='error') AS p FROM events GROUP BY 1,2) e ON u.user_id=e.user_id AND t.day=e.day)"""
DAYS = list(range(1, 31))


def _events(s, d):
    return table(s, d, "events").withColumn("day", F.dayofmonth("ts"))


def _cells(s, d):
    e = _events(s, d)
    scaffold = e.select("user_id").distinct().withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(30))))
    return R.status_of(e, ["user_id", "day"], scaffold, F.col("event_type") == "error")


@query(f"SELECT * FROM {_CELLS}")
def q_status_classify(s, d):
    return _cells(s, d)


@query("SELECT user_id, " + ", ".join(f"max(CASE WHEN day={x} THEN status END) AS d{x}" for x in DAYS) + f" FROM {_CELLS} GROUP BY 1")
def q_status_matrix(s, d):
    m = R.status_matrix(_cells(s, d), "user_id", "day", DAYS)
    return m.select("user_id", *[F.col(f"`{x}`").alias(f"d{x}") for x in DAYS])


@query(f"SELECT DISTINCT user_id FROM {_CELLS} WHERE status='Missing'")
def q_missing_any(s, d):
    return R.missing_any(_cells(s, d), "user_id")


def _rescue(s, d, share):
    c = _events(s, d).select("user_id", "day", F.col("value").alias("score"), F.col("event_id").alias("tie"))
    return R.rescue(_cells(s, d), c, "user_id", "day", 30, 30, share).select("user_id", "day", "score", F.col("tie").alias("event_id"), "support")


@query(f"""WITH c AS {_CELLS}, lost AS (SELECT user_id FROM c WHERE day=30 AND status='Missing'), found AS (SELECT DISTINCT user_id FROM c WHERE status='Complete'),
 pool AS (SELECT user_id, day(ts)::INT AS day, value AS score, event_id FROM events WHERE day(ts)<>30 AND value IS NOT NULL AND user_id IN (SELECT user_id FROM lost) AND user_id IN (SELECT user_id FROM found)),
 sup AS (SELECT user_id, count(DISTINCT day) AS support FROM pool GROUP BY 1)
 SELECT user_id, day, score, event_id, support FROM pool JOIN sup USING (user_id) WHERE support >= 30*0.85::DOUBLE QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, day, event_id)=1""")
def q_rescue(s, d):
    return _rescue(s, d, 0.85)


_STACK = ", ".join(f"count_if(status='{x}')::BIGINT AS {x[0].lower()}" for x in ("Complete", "Duplicated", "Fragmented", "Missing"))


@query(f"SELECT day, c AS s, d, f, m, (c+d)::BIGINT AS c, (c+d+f+m)::BIGINT AS n FROM (SELECT day, {_STACK} FROM {_CELLS} GROUP BY 1)")
def q_status_stack(s, d):
    names = {"s": "Complete", "d": "Duplicated", "f": "Fragmented", "m": "Missing"}
    per = _cells(s, d).groupBy("day").agg(*[F.count_if(F.col("status") == v).alias(k) for k, v in names.items()])
    return per.withColumn("c", F.expr("s + d")).withColumn("n", F.expr("s + d + f + m"))


@query(f"SELECT user_id, 'd' || day::VARCHAR AS variable, CASE status WHEN 'Complete' THEN 3 WHEN 'Duplicated' THEN 2 WHEN 'Fragmented' THEN 1 ELSE 0 END::INT AS value FROM {_CELLS}")
def q_heatmap_melt(s, d):
    long = q_status_matrix(s, d).unpivot("user_id", [f"d{x}" for x in DAYS], "variable", "status")
    code = F.when(F.col("status") == "Complete", 3).when(F.col("status") == "Duplicated", 2).when(F.col("status") == "Fragmented", 1).otherwise(0)
    return long.select("user_id", "variable", code.alias("value"))


@query("""WITH e AS (SELECT user_id, ts, event_id, event_type, CASE WHEN event_id % 3 <> 0 THEN value END AS value, CASE WHEN event_id % 2 = 0 THEN props END AS props FROM events),
 m AS (SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) THEN 1 ELSE 0 END AS new FROM e),
 i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS island FROM m)
 SELECT user_id, island, event_type, min(event_id) AS event_id, arg_min(value, (ts, event_id)) FILTER (WHERE value IS NOT NULL) AS value, arg_min(props, (ts, event_id)) FILTER (WHERE props IS NOT NULL) AS props
 FROM i GROUP BY 1, 2, 3""")
def q_islands_first(s, d):
    """Runs of one event type within a user; value and props are null in some rows, so that the first row is not always the answer."""
    e = table(s, d, "events").select("user_id", "ts", "event_id", "event_type", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 2 == 0, F.col("props")).alias("props"))
    return R.islands_first(e, "event_type", ["ts", "event_id"], ["user_id"]).select("user_id", "island", "event_type", "event_id", "value", "props")


@query("SELECT part::INT AS part, count(*) AS n FROM (SELECT ntile(4) OVER (ORDER BY n_nationkey) AS part FROM nation) GROUP BY 1")
def q_positional_split(s, d):
    from pyspark.sql import Window

    return table(s, d, "nation").withColumn("part", F.ntile(4).over(Window.orderBy("n_nationkey"))).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


_LINES = ["##A", "#MAIN_MENU", "alpha;u1", "beta;;u2", "##B", "dup;u3", "dup;u4", "plain"]


@query("SELECT * FROM (VALUES ('A','alpha','u1'),('A','beta','u2'),('B','dup',NULL),('B','dup',NULL)) t(section,name,url)")
def q_manifest_lookup(s, d):
    rows = ", ".join(f"({i}, '{x}')" for i, x in enumerate(_LINES))
    return readers.manifest(s.sql(f"SELECT * FROM VALUES {rows} AS t(line_no, line)"))


@query("SELECT doc_id, EXISTS (SELECT 1 FROM benchmark b WHERE contains(documents.text, b.text)) AS matched FROM documents")
def q_partition_semi_anti(s, d):
    docs = table(s, d, "documents").select("doc_id", "text")
    return R.flag_match(docs.select("doc_id"), R.contained_in(docs, "doc_id", "text", table(s, d, "benchmark"), "text"), "doc_id")


@query("SELECT event_id, user_id FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE n>=60 AND r<=70")
def q_cap_per_key(s, d):
    return R.cap_per_key(table(s, d, "events"), "user_id", ["event_id"], 60, 70).select("event_id", "user_id")


@query("SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY text")
def q_dedup_exact(s, d):
    key = F.sha2(F.col("text").cast("binary"), 256)  # the exchange carries digests, not texts
    return table(s, d, "documents").groupBy(key.alias("k")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).drop("k")


@query("""WITH l AS (SELECT length(text)::BIGINT AS len FROM documents), r AS (SELECT len, sum(len) OVER (ORDER BY len DESC RANGE UNBOUNDED PRECEDING) AS run, sum(len) OVER () AS t FROM l)
 SELECT count(*) AS n_seqs, max(t)::BIGINT AS total, round(max(t)::DOUBLE/count(*),4) AS mean_len, max(len) AS max_len, max(CASE WHEN run*2>=t THEN len END) AS n50 FROM r""")
def q_assembly_metrics(s, d):
    return R.n50(table(s, d, "documents").select(F.length("text").alias("l")), "l")


def _seeds(df, key, k=8):
    """Distinct k-mers of lower-cased text."""
    return df.select(key, F.explode(T.kmers(F.lower("text"), k)).alias("seed")).distinct()


_SEED = "(SELECT DISTINCT {0}, substr(lower(text), i, 8) AS seed FROM (SELECT {0}, text, unnest(range(1, greatest(length(text)-6, 1))) AS i FROM {1}))"


@query(f"""SELECT item_id, doc_id, n FROM (SELECT item_id, doc_id, count(*) AS n FROM {_SEED.format('item_id', 'benchmark')} b JOIN {_SEED.format('doc_id', 'documents')} d USING (seed) GROUP BY 1, 2)
 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY n DESC, doc_id)=1""")
def q_seed_join(s, d):
    asked = cut(_seeds(table(s, d, "benchmark"), "item_id"))
    known = asked.select("seed").distinct()
    # Seeds that nobody asks for go before the exchange, as long as those asked for are few.
    known = F.broadcast(known) if known.limit(R.MOST_PROBES + 1).count() <= R.MOST_PROBES else known
    found = table(s, d, "documents").select("doc_id", F.explode(T.kmers(F.lower("text"), 8)).alias("seed")).join(known, "seed", "left_semi").distinct()
    hits = dealt_join(found, asked, "seed").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return R.best_per_key(hits, "item_id", F.desc("n"), F.col("doc_id"))


@query("SELECT count_if(matched)::BIGINT AS matched, count(*) AS total, round(count_if(matched)::DOUBLE/count(*), 6) AS rate FROM (SELECT EXISTS (SELECT 1 FROM benchmark b WHERE contains(documents.text, b.text)) AS matched FROM documents)")
def q_mapping_rate(s, d):
    m = q_partition_semi_anti(s, d).agg(F.count_if("matched").alias("matched"), F.count(F.lit(1)).alias("total"))
    return m.withColumn("rate", F.round(F.col("matched") / F.col("total"), 6))


@query("""WITH c AS (SELECT doc_id, string_split(text, '') AS c FROM documents WHERE length(text) >= 4), p AS (SELECT doc_id, c, unnest(range(1, len(c) - 2)) AS i FROM c)
 SELECT doc_id AS id, i::INTEGER AS pos, score FROM (SELECT doc_id, i, ((c[i]='e')::INT + (c[i+1]='r')::INT + (c[i+2]='t')::INT + (c[i+3]='h')::INT)::DOUBLE * 1.5::DOUBLE - 2.0::DOUBLE AS score FROM p)
 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i)=1""")
def q_profile_scan(s, d):
    """Best place and score of a small position weight profile in each text."""
    from seqloom.operators import sequence

    return sequence.profile_scan(table(s, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("seq")), "erth")


def _nucleotides():
    """The text's letters as A, C, G and T."""
    return F.translate(F.lower(F.regexp_replace("text", "[^A-Za-z]", "")), "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")


_NT = "translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"


@query(f"""WITH g AS (SELECT b1.b || b2.b || b3.b AS codon, 'FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG'[16*b1.i + 4*b2.i + b3.i + 1] AS aa
  FROM (VALUES ('T',0),('C',1),('A',2),('G',3)) b1(b,i), (VALUES ('T',0),('C',1),('A',2),('G',3)) b2(b,i), (VALUES ('T',0),('C',1),('A',2),('G',3)) b3(b,i)),
 s AS (SELECT doc_id::VARCHAR AS id, {_NT} AS x FROM documents), t AS (SELECT id, 1 AS strand, x FROM s UNION ALL SELECT id, -1, reverse(translate(x, 'ACGT', 'TGCA')) FROM s),
 f AS (SELECT id, strand * (o + 1) AS frame, substr(x, o + 1) AS x FROM t, (VALUES (0),(1),(2)) v(o)),
 c AS (SELECT id, frame, i, substr(x, 3*i + 1, 3) AS codon FROM (SELECT id, frame, x, unnest(range(0, length(x) // 3)) AS i FROM f)),
 p AS (SELECT id, frame, string_split(string_agg(aa, '' ORDER BY i), '*') AS parts FROM c JOIN g USING (codon) GROUP BY 1, 2),
 q AS (SELECT id, frame, n, len(parts) AS m, parts[n] AS p FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS n FROM p)),
 o AS (SELECT id, frame, n, m, CASE WHEN n = 1 AND p[1] IS DISTINCT FROM 'M' THEN p WHEN position('M' IN p) > 0 THEN substr(p, position('M' IN p)) ELSE '' END AS pep FROM q)
 SELECT id, frame::INT AS frame, CASE WHEN pep[1] = 'M' THEN CASE WHEN n < m THEN 'complete' ELSE '3prime_partial' END WHEN n < m THEN '5prime_partial' ELSE 'internal' END AS orf_type, pep FROM o WHERE length(pep) >= 30""")
def q_orf_scan(s, d):
    """Open reading frames of pseudo-nucleotide texts."""
    from seqloom.operators import sequence

    return sequence.find_orfs(table(s, d, "documents").select(F.col("doc_id").cast("string").alias("id"), _nucleotides().alias("seq")), min_aa=30)


@query(f"""WITH s AS (SELECT doc_id::VARCHAR AS id, {_NT} AS x FROM documents), q AS (SELECT item_id::VARCHAR AS id, {_NT} AS x FROM benchmark),
 ss AS (SELECT id, i, substr(x, i + 1, 12) AS g FROM (SELECT id, x, unnest(range(0, greatest(length(x) - 11, 0))) AS i FROM s)), qs AS (SELECT id, i, substr(x, i + 1, 12) AS g FROM (SELECT id, x, unnest(range(0, greatest(length(x) - 11, 0))) AS i FROM q)),
 r AS (SELECT qs.id AS qid, ss.id AS sid, ss.i - qs.i AS diag, count(*) AS n, min(qs.i) AS a, max(qs.i) AS z FROM qs JOIN ss USING (g) GROUP BY 1, 2, 3 HAVING count(*) >= 2),
 b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY qid, sid ORDER BY n DESC, diag) = 1),
 m AS (SELECT qid, sid, a, diag, z - a + 12 AS len, length(q.x) AS m, list_sum(list_transform(range(0, z - a + 12), lambda j: CASE WHEN q.x[a + j + 1] = s.x[a + diag + j + 1] THEN 1 ELSE 0 END)) AS same FROM b JOIN q ON q.id = qid JOIN s ON s.id = sid),
 e AS (SELECT *, ((1.098612::DOUBLE * (same - (len - same))::DOUBLE) - ln(0.333::DOUBLE)) / ln(2::DOUBLE) AS bits, m * (SELECT sum(length(x)) FROM s) AS space FROM m)
 SELECT qid AS qseqid, sid AS sseqid, len::BIGINT AS length, (len - same)::BIGINT AS mismatch, (a + 1)::BIGINT AS qstart, (a + len)::BIGINT AS qend, (a + diag + 1)::BIGINT AS sstart, (a + diag + len)::BIGINT AS send, round(bits, 6) AS bitscore FROM e WHERE space * pow(2::DOUBLE, -bits) <= 0.001::DOUBLE""")
def q_homology(s, d):
    """Scored ungapped hits of the benchmark's sequences on the documents', by an index of seeds."""
    from seqloom.operators import search
    from seqloom.sources import files

    refs = cut(table(s, d, "documents").select(F.col("doc_id").cast("string").alias("id"), _nucleotides().alias("seq")))
    asked = cut(table(s, d, "benchmark").select(F.col("item_id").cast("string").alias("id"), _nucleotides().alias("seq")))
    hits = search.homology_hits(asked, refs, files.seeds(refs, "id", "seq", 12), 12)
    whole = lambda c: F.col(c).cast("long").alias(c)
    return hits.select("qseqid", "sseqid", *map(whole, ("length", "mismatch", "qstart", "qend", "sstart", "send")), F.round("bitscore", 6).alias("bitscore"))


_GRAM = "(SELECT {0}, least(g, reverse(translate(g, 'ACGT', 'TGCA'))) AS g FROM (SELECT {0}, substr(x, i, 10) AS g FROM (SELECT {0}, x, unnest(range(1, greatest(length(x) - 8, 1))) AS i FROM {1})))"


@query(f"""WITH r AS (SELECT conv_id, turn, {_NT} AS x FROM conversations), b AS (SELECT item_id, {_NT} AS x FROM benchmark), d AS (SELECT DISTINCT g FROM {_GRAM.format('item_id', 'b')}),
 h AS (SELECT conv_id, turn, count(*) AS n, count(d.g) AS hits FROM {_GRAM.format('conv_id, turn', 'r')} k LEFT JOIN d ON k.g = d.g GROUP BY 1, 2),
 m AS (SELECT DISTINCT conv_id FROM h WHERE hits > 0 AND hits >= 0.02::DOUBLE * n)
 SELECT conv_id, turn, conv_id IN (SELECT conv_id FROM m) AS matched FROM conversations""")
def q_reads_partition(s, d):
    """Reads of a database's kind: a conversation goes with it as a whole if either of its turns shares enough k-mers."""
    from seqloom.operators import search

    reads = cut(table(s, d, "conversations").select("conv_id", F.col("turn").alias("mate"), _nucleotides().alias("seq")))
    of, rest, _ = search.partition_reads(reads, table(s, d, "benchmark").select(_nucleotides().alias("seq")), 10, 0.02, "conv_id")
    out = of.withColumn("matched", F.lit(True)).unionByName(rest.withColumn("matched", F.lit(False)))
    return out.select("conv_id", F.col("mate").alias("turn"), "matched")


@query("""SELECT pos::INT + 1 AS pos, count(*) AS n, round(avg(q), 4) AS mean, quantile_cont(q, 0.1) AS p10, quantile_cont(q, 0.25) AS p25, quantile_cont(q, 0.5) AS p50, quantile_cont(q, 0.75) AS p75, quantile_cont(q, 0.9) AS p90
 FROM (SELECT i AS pos, (ord(h[i + 1]) - 33)::DOUBLE AS q FROM (SELECT h, unnest(range(0, length(h))) AS i FROM (SELECT sha256(url) AS h FROM pages))) GROUP BY 1""")
def q_quality_by_pos(s, d):
    """Mean and quantiles at every position of quality strings (a digest of each url stands in for them)."""
    from seqloom.operators import assembly

    return assembly.quality_by_position(table(s, d, "pages").select(F.sha2(F.col("url").cast("binary"), 256).alias("qual")))


_HIT = "CASE WHEN c_custkey % {0} = 0 THEN '.' ELSE c_mktsegment || '^' || c_name END"


@query("SELECT '>' || c_custkey::VARCHAR || ' SwissProt_Blastx:' || CASE WHEN c_custkey % 2 = 0 THEN 'noHit' ELSE c_mktsegment END || ' UniProt_Blastp:' || CASE WHEN c_custkey % 5 = 0 THEN 'noHit' ELSE c_mktsegment END AS header FROM customer")
def q_annotation_headers(s, d):
    rows = table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("c1"), *[F.expr(_HIT.format(m)).alias(c) for c, m in (("c3", 2), ("c7", 3), ("c8", 4), ("c9", 5))])
    return rows.select(T.annotation_header(("swissprot", "nucl"), ("uniprot", "prot")).alias("header"))


@query(f"""SELECT CASE day WHEN 29 THEN 'x' ELSE 'x_final' END AS species, unnest(['S','D','F','M']) AS category, unnest([c, d, f, m])::BIGINT AS n, round(100 * unnest([c, d, f, m])::DOUBLE / (c + d + f + m), 1) AS percent
 FROM (SELECT day, {_STACK} FROM {_CELLS} WHERE day IN (29, 30) GROUP BY 1)""")
def q_status_vectors(s, d):
    """The label, category, count and percent vectors of two sets side by side."""
    per = q_status_stack(s, d).where("day IN (29, 30)").select(F.when(F.col("day") == 29, "x").otherwise("x_final").alias("species"), F.col("n").alias("_all"), *[F.col(c).alias(c.upper()) for c in "sdfm"])
    long = per.unpivot(["species", "_all"], list("SDFM"), "category", "n")
    return long.select("species", "category", "n", F.round(100 * F.col("n") / F.col("_all"), 1).alias("percent"))


@query("""WITH c AS (SELECT doc_id, string_split(upper(regexp_replace(text, '[^A-Za-z]', '_', 'g')), '') AS c FROM documents WHERE length(text) >= 4), p AS (SELECT doc_id, c, unnest(range(1, len(c) - 2)) AS i FROM c)
 SELECT doc_id::VARCHAR AS query, 'erth' AS domain, i::INTEGER AS ali_from, (i + 3)::INTEGER AS ali_to, score FROM (SELECT doc_id, i, ((c[i]='E')::INT * 3 + (c[i+1]='R')::INT * 4 + (c[i+2]='T')::INT * 3 + (c[i+3]='H')::INT * 5 - 4)::DOUBLE AS score FROM p)
 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i)=1""")
def q_profile_hits(s, d):
    """The best place of a profile table's profile in every text, with its expectation."""
    from seqloom.operators import sequence

    rows = ", ".join(f"('erth', 'P1', {p}, '{c}', {w}D, 1.0D, 0.7D)" for p, c, w in ((1, "E", 2.0), (2, "R", 3.0), (3, "T", 2.0), (4, "H", 4.0)))
    profile = s.sql(f"SELECT * FROM VALUES {rows} AS t(domain, accession, pos, letter, score, mu, lambda)")
    texts = table(s, d, "documents").select(F.col("doc_id").alias("id"), F.regexp_replace("text", "[^A-Za-z]", "_").alias("seq"))
    return sequence.profile_hits(texts, profile, other=-1.0, max_evalue=float("inf")).select("query", "domain", "ali_from", "ali_to", "score")


@query()
def q_species_split(s, d):
    """Linear classifier on hashed k-mers, fitted on four fifths of the labelled documents, for all documents (rows only)."""
    from seqloom.operators import sequence

    docs = table(s, d, "documents").join(table(s, d, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id", "left")
    return sequence.species_split(docs.select("doc_id", "text", F.col("label").cast("double").alias("label")))


@query(r"""WITH RECURSIVE t AS (SELECT doc_id AS id, length(text) AS n, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM documents),
 g AS (SELECT DISTINCT id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+4], ' ') END AS g FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)),
 c AS (SELECT id, count(*) AS c FROM g GROUP BY 1), p AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM g x JOIN g y ON x.g = y.g AND x.id <> y.id GROUP BY 1, 2),
 l AS (SELECT a, b FROM p JOIN c x ON x.id = a JOIN c y ON y.id = b WHERE k::DOUBLE / (x.c + y.c - k) >= 0.8::DOUBLE),
 r AS (SELECT id AS a, id AS b FROM t UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a), m AS (SELECT a AS id, min(b) AS group_id FROM r GROUP BY 1)
 SELECT id, group_id, (count(*) OVER (PARTITION BY group_id))::BIGINT AS n_in_group, row_number() OVER (PARTITION BY group_id ORDER BY coalesce(n, 0) DESC, id) = 1 AS kept FROM m JOIN t USING (id)""")
def q_dedup_near(s, d):
    """The near-duplicate group of every text, by MinHash bands and the similarity of shingle sets; the longest of each is kept."""
    from seqloom.operators import sequence

    return sequence.near_groups(table(s, d, "documents").select(F.col("doc_id").alias("id"), "text"))


@query(f"SELECT doc_id::VARCHAR AS read_id, {_NT} AS seq, repeat('@', length({_NT})) AS qual FROM documents")
def q_fastq_scan(s, d):
    """FASTQ files made from the data, read back by the data source; quality lines start like headers."""
    from seqloom.operators.shuffle import checkpoint_dir

    s.dataSource.register(readers.FastqSource)
    path = f"{checkpoint_dir(s)}/fastq-{uuid.uuid4().hex}"
    reads = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("id"), _nucleotides().alias("seq"))
    reads.select(F.concat(F.lit("@"), "id", F.lit(" read\n"), "seq", F.lit("\n+\n"), F.expr("repeat('@', length(seq))"))).write.text(path)
    return s.read.format("fastq").option("path", f"{path}/part-*").load().drop("path", "pair_no")


@query(f"""WITH t AS (SELECT conv_id, {_NT} AS s FROM conversations), g AS (SELECT conv_id, substr(s, i, 6) AS g FROM (SELECT conv_id, s, unnest(range(1, greatest(length(s)-4, 1))) AS i FROM t)),
 c AS (SELECT conv_id, least(g, reverse(translate(g, 'ACGT', 'TGCA'))) AS kmer FROM g), n AS (SELECT kmer, count(*) AS n FROM c GROUP BY 1),
 m AS (SELECT conv_id, median(n)::DOUBLE AS cov FROM c JOIN n USING (kmer) GROUP BY 1)
 SELECT conv_id, turn FROM conversations JOIN m USING (conv_id) WHERE cov >= 2 AND ('0x' || substr(md5(conv_id::VARCHAR), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE * cov < 20""")
def q_normalize_reads(s, d):
    from seqloom.operators import assembly

    reads = table(s, d, "conversations").select("conv_id", "turn", _nucleotides().alias("seq"))
    return assembly.normalise_pairs(reads, 6, 2, 20, "conv_id").select("conv_id", "turn")


@query()
def q_assemble(s, d):
    """Unitigs of pseudo-nucleotide texts at k = 25 (rows only; tests hold the operator against brute force)."""
    from seqloom.operators import assembly

    return assembly.unitigs(table(s, d, "benchmark").select(_nucleotides().alias("seq")), 25)


@query("SELECT user_id::VARCHAR AS key, (count(*) // 5)::BIGINT AS n_groups FROM events GROUP BY 1 HAVING count(*) >= 5")
def q_stream_groups(s, d):
    from seqloom.streaming import grouping

    whole = table(s, d, "events")
    rows = s.readStream.schema(whole.schema).parquet(f"{d}/events*.parquet")  # a glob: the source takes folders or patterns
    out = grouping.drain(grouping.group_exact_n_stream(rows, "user_id", F.col("event_id"), 5))
    return out.groupBy("key").agg(F.count(F.lit(1)).alias("n_groups"))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: completeness rescue at the default support of 0.70."""
    return _rescue(spark, sf_dir, 0.70)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
