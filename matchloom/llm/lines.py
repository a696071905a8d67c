"""Line dedup by content-defined line chunks, in DataFrame functions only.

A text is cut behind every newline and, as a paragraph can be one long line, behind sentence and clause marks
that a space follows; the pieces are its lines, and what counts of a line are its bytes without the newline and blanks
around it. A window of three lines rolls over the hashes of lines; a chunk ends behind the middle one where its hash is lower
than both its neighbours'. The place depends on three lines alone, so equal passages are cut alike wherever they stand, and
chunks inside a text hold two lines at least. A line of LONG_LINE bytes or more (some 16 words) is a chunk of its own, with a
boundary on either side: a passage can be one line without any mark, and one of few lines may hold no whole chunk else.

A chunk of several lines with CHUNK bytes or more, or of one long line, that occurs more than once is kept where it comes
first, by (doc_id, position), and removed elsewhere, once the bytes of its lines are compared with the other
occurrences'. (CHUNK says what a passage is: some eight words of a spaced script, thirteen signs of one without spaces; shorter
clauses recur in any prose.) Chunk hashes are counted with partial sums; only the texts of documents with a chunk whose hash
repeats are cut up for the comparison. Joins deal common chunks over several partitions.

Defined cases: rows equal in doc_id and text are one document and keep the same chunks; rows that share only
doc_id are told apart by their text's hash; null doc_id comes last; null or empty text stays; an empty table
gives an empty one; all other columns pass through, n_chars (if there) is counted anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm.common import cut, discard, read, salted_join

# The strings behind which a line ends.
LINE_ENDS = ("\n", ". ", "! ", "? ", "; ", ": ", ", ", "… ", "。", "！", "？", "；", "，", "、")
#: Bytes of a chunk of several lines, and of a line that is a chunk by itself.
CHUNK, LONG_LINE = 40, 80
#: Bytes of the list of what is removed up to which it is broadcast; beyond it texts are shuffled to it.
BROADCAST = 16 << 20
_CUT = "\x01"


def lines(text: Column) -> Column:
    """The lines of a text, which joined give it again. Plain replacements beat a pattern with lookbehind twofold."""
    marked = text
    for end in LINE_ENDS:
        marked = F.replace(marked, F.lit(end), F.lit(end + _CUT))
    slow = F.split(text, "|".join(f"(?<={e if e[0] not in '.?' else '[' + e[0] + '] '})" for e in LINE_ENDS))
    return F.when(F.contains(text, F.lit(_CUT)), slow).otherwise(F.split(marked, _CUT))


def bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \n"))


def chunks(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), chunks: array of (start, stop, hash); lines start + 1 to stop, several with CHUNK bytes or one long one."""
    cut_up = docs.where("text != ''").select("doc_id", F.xxhash64("text").alias("key"), F.transform(lines(F.col("text")), bare).alias("v"))
    hashed = cut_up.withColumns({"h": F.transform("v", lambda x: F.xxhash64(x)), "size": F.transform("v", lambda x: F.octet_length(x))})
    rolled = hashed.withColumn("n", F.size("h"))
    low = F.when(
        F.col("n") >= 3,
        F.filter(F.sequence(F.lit(2), F.col("n") - 1), lambda i: (F.get("h", i - 1) < F.get("h", i - 2)) & (F.get("h", i - 1) < F.get("h", i))),
    ).otherwise(F.array().cast("array<int>"))
    long = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: F.get("size", i - 1) >= LONG_LINE)
    around = F.flatten(F.transform(long, lambda i: F.array(i - 1, i)))
    stops = F.array_sort(F.array_distinct(F.filter(F.concat(low, around, F.array("n")), lambda i: i > 0)))
    ended = rolled.withColumn("stops", stops).withColumn("starts", F.concat(F.array(F.lit(0)), "stops"))
    found = F.zip_with("starts", "stops", lambda a, b: F.struct(a.alias("start"), b.alias("stop")))  # the last start has no stop
    held = lambda c: F.aggregate(F.slice("size", c["start"] + 1, c["stop"] - c["start"]), F.lit(0), lambda a, x: a + x)
    kept = F.filter(found, lambda c: F.when(c["stop"] - c["start"] == 1, F.get("size", c["start"]) >= LONG_LINE).otherwise(held(c) >= CHUNK))
    hash_of = F.transform("c", lambda c: F.struct(c["start"], c["stop"], F.xxhash64(F.slice("h", c["start"] + 1, c["stop"] - c["start"])).alias("hash")))
    return ended.withColumn("c", kept).select("doc_id", "key", hash_of.alias("chunks"))


def repeats(docs: DataFrame, pool: list[str]) -> DataFrame:
    """Chunks to remove: doc_id, key, start, stop. pool: gets the tables behind it."""
    spread = cut(chunks(docs), "line-chunks", pool).select("doc_id", "key", F.explode("chunks").alias("c")).select("doc_id", "key", "c.*")
    often = cut(spread.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "line-often", pool)
    marked = salted_join(spread, often, "hash").drop("n")
    per_doc = marked.groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "stop")).alias("c"))
    texts = docs.where("text != ''").select("doc_id", F.xxhash64("text").alias("key"), "text").alias("t")
    met = texts.join(per_doc.hint("merge").alias("m"), F.expr("t.key = m.key and t.doc_id <=> m.doc_id"))
    cut_up = met.select("t.doc_id", "t.key", F.transform(lines(F.col("text")), bare).alias("v"), "c")
    body = lambda c: F.array_join(F.slice("v", c["start"] + 1, c["stop"] - c["start"]), "\n")
    bodies = F.transform("c", lambda c: F.struct(c["start"], c["stop"], body(c).alias("body")))
    bodies = cut_up.select("doc_id", "key", F.explode(bodies).alias("c")).select("doc_id", "key", "c.*")
    bodies = cut(bodies.withColumns({"b1": F.xxhash64("body"), "b2": F.xxhash64("body", F.lit(7))}), "line-bodies", pool)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "start")
    # Bytes are compared here: chunks of one group are equal. Two groups with the same pair of hashes would both be kept as they are
    groups = bodies.groupBy("b1", "b2", "body").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = groups.groupBy("b1", "b2").agg(F.count("*").alias("bodies"), F.min("first").alias("first"), F.sum("n").alias("n")).where("bodies = 1 and n > 1")
    first = cut(first.select("b1", F.col("b2").alias("b"), "first", "n"), "line-first", pool)
    met = salted_join(bodies.select("doc_id", "key", "start", "stop", "b1", "b2"), first, "b1")
    return met.where("b2 = b").where(~place.eqNullSafe(F.col("first"))).select("doc_id", "key", "start", "stop").distinct()


def dedup_lines(docs: DataFrame, counts: bool = True) -> DataFrame:
    """docs with repeated chunks taken out of text; counts adds (or replaces) chunks_removed and chars_removed."""
    pool: list[str] = []
    places = F.array_sort(F.collect_list(F.struct("start", "stop")))
    told = F.array_join(F.transform(places, lambda g: F.concat_ws("-", g["start"].cast("string"), g["stop"].cast("string"))), ",")
    gone = repeats(docs, pool).groupBy(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).agg(told.alias("__gone"))
    gone = cut(gone, "line-gone")
    discard(pool)
    rows, chars = gone.agg(F.count("*"), F.coalesce(F.sum(F.length("__gone")), F.lit(0))).first()
    per_doc = F.broadcast(gone) if 80 * rows + chars <= BROADCAST else gone.hint("merge")
    met = docs.join(per_doc, F.xxhash64("text").eqNullSafe(F.col("__key")) & docs["doc_id"].eqNullSafe(F.col("__id")), "left")
    number = lambda g, i: F.get(F.split(g, "-"), F.lit(i)).cast("int")
    each = F.transform(F.split("__gone", ","), lambda g: F.struct(number(g, 0).alias("start"), number(g, 1).alias("stop")))
    cut_up = met.withColumn("__g", each).withColumn("__u", F.when(F.col("__gone").isNotNull(), lines(F.col("text"))))
    from_ = F.concat(F.array(F.lit(0)), F.transform("__g", lambda g: g["stop"]))
    to = F.concat(F.transform("__g", lambda g: g["start"]), F.array(F.size("__u")))
    kept = F.zip_with(from_, to, lambda a, b: F.array_join(F.slice("__u", a + 1, b - a), ""))
    text = F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, ""))
    done = cut_up.withColumn("__text", text)
    new = {"text": F.col("__text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("__text").cast(docs.schema["n_chars"].dataType)
    if counts:
        new["chunks_removed"] = F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__g")).cast("long")
        new["chars_removed"] = F.coalesce(F.length(docs["text"]) - F.length("__text"), F.lit(0)).cast("long")
    names = [*docs.columns, *(c for c in new if c not in docs.columns)]
    return done.select(*[new[c].alias(c) if c in new else docs[c] for c in names])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "text", "chunks_removed", "chars_removed")
