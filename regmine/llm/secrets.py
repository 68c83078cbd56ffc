"""Secret scan with multipart credential linking (operator 10), DataFrame functions only.

Base spans come from three patterns.  ``split`` and ``regexp_extract_all`` cut a
text at the same leftmost non-overlapping matches, so the running sum of piece
and match lengths (a window per document and kind) gives every match's place in
code points.

Linking.  Weak candidates are an identifier (a user, account or client id), a
short secret (an assignment whose value is too short for a base span) and an
endpoint (a URL or host).  Within a scope of ``SCOPE`` code points, an interval
join by two ordered windows per document finds, for every part, the nearest
identifier and the nearest secret before and after it.  A weak identifier is
reported if a secret is in its scope, a weak secret if an identifier is, an
endpoint if both are.  Base spans always stay; an access key serves as a strong
identifier, an assignment as a strong secret, a hex run as neither, so a text
without an assignment links nothing.  No pairs are formed, so thousands of parts in one document cost a sort.

Null and empty texts have no spans.  Rows are told apart by (id, text hash,
length), null ids included; repeated rows get equal results.  Very long texts are
cut whole into pieces, one array per kind.  Empty tables give no rows.  Candidate rows are shuffled by document; texts are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regmine.llm.common import BROADCAST_BYTES, id_and_text, unused, write_shared

# fixed values: the patterns of the contract, and its limits
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# greedy runs: a run that is too short holds no longer match inside it, so the
# limits of these two can stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_CHARS = 12

# parts that count only together
SCOPE = 200                  # code points between the nearest edges of two parts
WEAK_SECRET_CHARS = 6        # shortest value of a weak secret
IDENTIFIER = (r"""(?i)(?<![A-Za-z0-9_])(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key_?id)["']?"""
              r"""\x20*[:=]\x20*["']?[A-Za-z0-9@+/_.-]{3,}""")
ENDPOINT = r"""(?i)(?<![A-Za-z0-9_])(?:(?:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D"'<>]+"""
ENDPOINT += r"""|(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.-]+)"""
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
MASK = "[SECRET]"
SPAN_BYTES, KEY_BYTES = 48, 96   # of a span and of a document's key in a broadcast table


def _pieces(text, kind: str, pattern: str, strong):
    """Array of (kind, gap before the match, its length, strength)."""
    parts = F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda p, m: F.when(m.isNotNull(), F.struct(
            F.lit(kind).alias("kind"), F.length(p).alias("gap"), F.length(m).alias("len"),
            strong(m).alias("strength"))))
    return F.filter(parts, lambda x: x.isNotNull())


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Reported spans, one row each: doc_id, h, chars (the document's key),
    kind, start, end (code points, end exclusive).  A short secret is of kind
    'secret'; added spans may overlap base ones."""
    src = id_and_text(docs, id_col, text_col)
    text = F.col("text")
    none = F.array().cast("array<struct<kind:string,gap:int,len:int,strength:string>>")
    # 2: base span, 1: weak candidate, 0: only counts for the places after it
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2))
    by_value = lambda m: F.when(value(m) >= ASSIGN_CHARS, F.lit("base")).when(
        value(m) >= WEAK_SECRET_CHARS, F.lit("weak")).otherwise(F.lit("none"))
    always = lambda s: lambda m: F.lit(s)
    has_assign = text.rlike(ASSIGN)
    found = F.concat(
        F.when(text.contains("AKIA"), _pieces(text, "access", ACCESS, always("base"))).otherwise(none),
        F.when(text.rlike(HEX), _pieces(text, "hex", HEX, always("base"))).otherwise(none),
        F.when(has_assign, F.concat(
            _pieces(text, "assign", ASSIGN, by_value),
            # without an assignment there is no secret, strong or weak, to link
            _pieces(text, "identifier", IDENTIFIER, always("weak")),
            _pieces(text, "endpoint", ENDPOINT, always("weak")))).otherwise(none))
    key = ["doc_id", "h", "chars"]
    rows = (src.where(text.isNotNull())
            .select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").alias("chars"),
                    F.posexplode_outer(found).alias("i", "m"))
            .where(F.col("m").isNotNull()).select(*key, "i", "m.*")
            .repartition(*key).dropDuplicates([*key, "i"]))
    upto = Window.partitionBy(*key, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto))
              .withColumn("start", F.col("end") - F.col("len"))
              .where(F.col("strength") != "none"))
    order = ["start", "end", "kind"]
    doc = Window.partitionBy(*key)
    back = doc.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = doc.orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    is_id, is_secret = F.col("kind").isin("identifier", "access"), F.col("kind") == "assign"

    def near(which):
        before = F.col("start") - F.max(F.when(which, F.col("end"))).over(back)
        after = F.min(F.when(which, F.col("start"))).over(ahead) - F.col("end")
        return F.coalesce(before <= SCOPE, F.lit(False)) | F.coalesce(after <= SCOPE, F.lit(False))

    linked = placed.withColumn("near_id", near(is_id)).withColumn("near_secret", near(is_secret))
    keep = (F.col("strength") == "base") | (
        F.when(F.col("kind") == "identifier", F.col("near_secret"))
        .when(F.col("kind") == "assign", F.col("near_id"))
        .otherwise(F.col("near_id") & F.col("near_secret")))
    return linked.where(keep).select(
        *key, F.when((F.col("kind") == "assign") & (F.col("strength") == "weak"), F.lit("secret"))
        .otherwise(F.col("kind")).alias("kind"), "start", "end")


def _gathered(docs, id_col, text_col):
    """Spans per document: id, text hash and length (the key), found."""
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    return (find_spans(docs, id_col, text_col).groupBy("doc_id", "h", "chars")
            .agg(F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("found"))
            .select(F.col("doc_id").alias("_k_id"), F.col("h").alias("_k_h"), F.col("chars").alias("_k_chars"),
                    F.col("found").alias("_found")))


def _by_document(docs, id_col, text_col):
    """(_id, spans) of every row of docs."""
    gathered = _gathered(docs, id_col, text_col)
    left = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_h"),
                       F.octet_length(F.col(text_col).cast("string")).alias("_chars"))
    same = (left["_id"].eqNullSafe(gathered["_k_id"]) & (left["_h"] == gathered["_k_h"])
            & (left["_chars"] == gathered["_k_chars"]))
    return left.join(gathered, same, "left")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256
    (of the base spans as kind:start:end by start, then kind, comma-joined),
    spans (all spans, joined likewise) and n_linked (added spans)."""
    rows = _by_document(docs, id_col, text_col)
    found = F.coalesce(F.col("_found"), F.array().cast(rows.schema["_found"].dataType))
    count = lambda k: F.size(F.filter(found, lambda s: s["kind"] == k)).cast("bigint")
    write = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter(found, lambda s: s["rank"] <= 3)
    return rows.select(
        F.col("_id").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(write(base), 256).alias("base_sha256"), write(found).alias("spans"),
        F.size(F.filter(found, lambda s: s["rank"] > 3)).cast("bigint").alias("n_linked"))


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every reported span replaced by ``MASK`` (overlapping spans
    by one); all rows and columns, of any name, stay; documents without spans are
    unchanged.  Texts are only shuffled if the spans exceed ``BROADCAST_BYTES``."""
    k_id, k_h, k_chars, found = unused(docs, "_k_id", "_k_h", "_k_chars", "_found")
    spans = write_shared(_gathered(docs, id_col, text_col).toDF(k_id, k_h, k_chars, found), "secret-spans")
    size = spans.agg(F.coalesce(F.sum(F.size(found) * SPAN_BYTES + KEY_BYTES), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:          # few documents have any: the texts stay where they are
        spans = F.broadcast(spans)
    text = F.col(text_col)
    whole = text.cast("string")
    rows = docs.join(spans, docs[id_col].eqNullSafe(spans[k_id]) & (F.xxhash64(whole) == spans[k_h])
                     & (F.octet_length(whole) == spans[k_chars]), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("pos"))
    walked = F.aggregate(
        F.col(found), start,
        lambda acc, s: F.when(s["start"] >= acc["pos"], F.struct(
            F.concat(acc["out"], F.substring(text, (acc["pos"] + 1).cast("int"),
                                             (s["start"] - acc["pos"]).cast("int")), F.lit(MASK)).alias("out"),
            s["end"].alias("pos"))).otherwise(F.struct(
                acc["out"].alias("out"), F.greatest(acc["pos"], s["end"]).alias("pos"))),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["pos"] + 1).cast("int"), F.lit(2 ** 31 - 1))))
    new = F.when(F.col(found).isNull(), text).otherwise(walked)
    return rows.select(*[new.alias(c) if c == text_col else F.col(c) for c in docs.columns])
