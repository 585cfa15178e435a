"""A word index of landed mail, for phrase searches.

``land_index`` writes one row per word of every text part, subject and sender:
``(day, token, message_id, part_seq, position)``, in folders by day of receipt
and sorted by word within a file.  A search then opens the folders of its
window, skips the row groups without its words (their least and greatest word
are in the file's statistics) and joins the places that are left: no body is
decoded again.

Words are runs of letters and digits, in lower case, as in a mailbox's own
search; the plain scan in ``mail.search`` tests the phrase as a piece of text
instead, so it also finds a phrase inside longer words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from bidlake.functions import dates as D
from bidlake.functions import text as T
from bidlake.session import stored
from bidlake.sources.mail import header, received_day

# --- fixed values -----------------------------------------------------------
WORD = r"[\p{L}\p{N}]+"
SUBJECT_PART, SENDER_PART = -2, -1     # the headers that a search covers, as parts
# ---------------------------------------------------------------------------
FILE_BYTES = 64 << 20                  # text that goes into one file of postings, about
INDEX_SCHEMA = StructType([
    StructField("token", StringType()), StructField("message_id", StringType()), StructField("part_seq", IntegerType()),
    StructField("position", IntegerType()), StructField("day", DateType())])


def words(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(T.col_(text)), F.lit(WORD), F.lit(0))


def searched_texts(messages: DataFrame, parts: DataFrame) -> DataFrame:
    """day, message_id, part_seq, text of all that a search covers; parts without a message are left out.

    A message whose id is null cannot be told from others and is left out; one
    that tells no day has a null day.
    """
    known = messages.where("id is not null").select(F.col("id").alias("message_id"), received_day().alias("day"), "headers")
    heads = known.select("day", "message_id", F.explode(F.array(
        F.struct(F.lit(SUBJECT_PART).alias("part_seq"), header("headers", "subject").alias("text")),
        F.struct(F.lit(SENDER_PART).alias("part_seq"), header("headers", "from").alias("text")))).alias("h")).select("day", "message_id", "h.*")
    bodies = parts.where(F.col("mime_type").startswith("text/")).join(known.select("message_id", "day").distinct(), "message_id")
    return heads.unionByName(bodies.select("day", "message_id", "part_seq", D.base64url_text("body_b64").alias("text")))


def land_index(messages: DataFrame, parts: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Write the index of whole texts.

    Texts are shuffled before they become words, so the dearer rows never
    move.  A day gets as many files as its bytes ask for, dealt by message: a
    day with a third of all mail, or a word on every line, fills no one task.
    """
    texts = stored(searched_texts(messages, parts))
    sizes = texts.groupBy(F.col("day").alias("_day")).agg(F.ceil((F.sum(F.octet_length("text")) + 1) / F.lit(file_bytes)).cast("int").alias("files"))
    dealt = texts.join(stored(sizes), F.col("day").eqNullSafe(F.col("_day"))).select(
        "day", "message_id", "part_seq", "text", F.pmod(F.xxhash64("message_id"), F.col("files")).alias("file"))
    placed = dealt.repartition("day", "file").select("day", "message_id", "part_seq", F.posexplode(words("text")).alias("position", "token"))
    (placed.select(*INDEX_SCHEMA.names).sortWithinPartitions("day", "token", "message_id", "part_seq", "position")
     .write.mode("overwrite").partitionBy("day").parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def phrase_places(index: DataFrame, phrases: list[str], since: str | None = None) -> DataFrame:
    """phrase, message_id, part_seq, places: where the words of a phrase follow each other, and how often.

    ``since`` (ISO date) bounds the day of receipt; messages that tell no day
    stay in.  A place of the i-th word votes for the start i words before; a
    start with a vote for each word is a match, so no two places are paired
    and a frequent word costs one row for each of its places.  Phrases without
    a word match nothing; equal phrases count once.
    """
    spark = index.sparkSession
    given = spark.createDataFrame([(p,) for p in dict.fromkeys(phrases)], "phrase string")
    asked = given.select("phrase", F.size(words("phrase")).alias("n"), F.posexplode(words("phrase")).alias("i", "token"))
    tokens = sorted({r["token"] for r in asked.select("token").collect()})  # the caller's own words
    inside = F.col("token").isin(tokens)
    if since is not None:
        inside &= F.col("day").isNull() | (F.col("day") >= F.lit(since).cast("date"))
    votes = index.where(inside).join(F.broadcast(asked), "token")  # the words of the phrases: a stated list
    starts = votes.groupBy("phrase", "n", "message_id", "part_seq", (F.col("position") - F.col("i")).alias("start")).agg(F.count("*").alias("votes"))
    return starts.where("votes = n").groupBy("phrase", "message_id", "part_seq").agg(F.count("*").alias("places"))


def phrase_holders(index: DataFrame, phrase: str, since: str | None = None) -> DataFrame:
    """message_id of the messages with the phrase in a text part, the subject or the sender."""
    return phrase_places(index, [phrase], since).select("message_id").distinct()
