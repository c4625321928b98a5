"""Derived inputs built from the driver tables with integer rules only.

The labelled text is ``documents JOIN labels USING (doc_id)``. Four label
encodings are laid over it by ``doc_id % 4`` in ONE projection (one scan, one
join): a per-source filter would be pushed through the join into four
separate scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The source encodings, in the order they are added to the corpus.
SOURCE_NAMES = ("onehot", "multifile", "binary", "ordinal")

# Raw text column name of each source encoding.
SOURCE_TEXT_COLUMNS = {"onehot": "user", "multifile": "Text", "binary": "Comment",
                       "ordinal": "tweet"}


def labelled_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, text, client, n_chars, quality, toxic)``; client = data owner."""
    return (documents.join(labels, "doc_id", "inner")
            .select("doc_id", "text", F.col("source").alias("client"), "n_chars",
                    "quality", "toxic"))


def encoded_sources(labelled: DataFrame) -> DataFrame:
    """Wide table with every source's label columns (NULL outside its source).

    onehot    ``doc_id % 4 = 0``: votes m1/m2/m3 = toxic on ``doc_id % 3``, p1 = 1 - toxic
    multifile ``doc_id % 4 = 1``: oh_label = toxic, file = client
    binary    ``doc_id % 4 = 2``: hateful = toxic
    ordinal   ``doc_id % 4 = 3``: class 0/1 when toxic (by quality), else 2
    """
    part = F.col("doc_id") % 4
    third = F.col("doc_id") % 3
    toxic, quality = F.col("toxic"), F.col("quality")

    def only(k: int, value: Column) -> Column:
        return F.when(part == k, value)

    names = F.array(*[F.lit(s) for s in SOURCE_NAMES])
    ordinal = (F.when(toxic.isNull(), F.lit(None))
               .when((toxic == 1) & (quality == 0), F.lit(0))
               .when((toxic == 1) & (quality == 1), F.lit(1))
               .otherwise(F.lit(2)))
    return labelled.select(
        "doc_id", "text", "client",
        F.element_at(names, (part + 1).cast("int")).alias("source"),
        (part + 1).cast("int").alias("seq"),
        only(0, toxic * (third == 0).cast("int")).alias("m1"),
        only(0, toxic * (third == 1).cast("int")).alias("m2"),
        only(0, toxic * (third == 2).cast("int")).alias("m3"),
        only(0, 1 - toxic).alias("p1"),
        only(1, toxic).alias("oh_label"),
        only(1, F.col("client")).alias("file"),
        only(2, toxic).alias("hateful"),
        only(3, ordinal).alias("class"),
    )


def raw_source(encoded: DataFrame, name: str) -> DataFrame:
    """One source in its raw shape (original text column name), for CSV tests."""
    cols = {"onehot": ["m1", "m2", "m3", "p1"], "multifile": ["oh_label", "file"],
            "binary": ["hateful"], "ordinal": ["class"]}[name]
    return (encoded.filter(F.col("source") == name)
            .select(F.col("text").alias(SOURCE_TEXT_COLUMNS[name]), *cols))


def conflicting_annotations(labelled: DataFrame) -> DataFrame:
    """All labelled rows plus a second annotator for ``doc_id % 10 = 0``
    whose label is ``1 - toxic`` (for the conflicting-label report)."""
    first = labelled.select("doc_id", "text", F.col("toxic").alias("objectionable"))
    second = (labelled.filter(F.col("doc_id") % 10 == 0)
              .select("doc_id", "text", (1 - F.col("toxic")).alias("objectionable")))
    return first.unionByName(second)


def content_of(embedding: Column) -> Column:
    """Text form of a vector (micro units), the content that uploads are hashed by."""
    return F.array_join(F.transform(embedding, lambda x: F.round(
        x.cast("double") * 1_000_000).cast("bigint").cast("string")), ",")


def client_updates(embeddings: DataFrame) -> DataFrame:
    """Client updates: ``(version, client_id, upload_seq, content_hash, sample_size, embedding)``.

    version = label, client = vec_id, content_hash = SHA-256 of the content,
    sample_size = ``1 + vec_id % 97 + upload_seq``. Every seventh client uploads
    its model twice, so content and weights repeat; every fifth client also
    uploads under the id ``vec_id + 1000000``, so two clients share content.
    """
    v = F.col("vec_id")
    uploads = F.array_compact(F.array(
        F.struct(v.alias("client_id"), F.lit(0).alias("upload_seq")),
        F.when(v % 7 == 0, F.struct(v.alias("client_id"), F.lit(1).alias("upload_seq"))),
        F.when(v % 5 == 0, F.struct((v + 1_000_000).alias("client_id"),
                                    F.lit(2).alias("upload_seq")))))
    rows = embeddings.select("label", "vec_id", "embedding",
                             F.sha2(content_of(F.col("embedding")), 256).alias("content_hash"),
                             F.explode(uploads).alias("u"))
    return rows.select(
        F.col("label").cast("int").alias("version"), "u.client_id", "u.upload_seq",
        "content_hash", (1 + v % 97 + F.col("u.upload_seq")).alias("sample_size"), "embedding")


def objects_with_gaps(updates: DataFrame) -> DataFrame:
    """Stored uploads: every update except of ``client_id % 17 = 0``."""
    return updates.filter(F.col("client_id") % 17 != 0)


def weights_with_gaps(updates: DataFrame) -> DataFrame:
    """Recorded weights: every update except of ``client_id % 13 = 0``; keys repeat."""
    return (updates.filter(F.col("client_id") % 13 != 0)
            .select("version", "content_hash", "upload_seq", "sample_size"))


def upload_records(documents: DataFrame) -> DataFrame:
    """Upload bodies built from documents: ``(doc_id, version, body)``.

    body = JSON ``{"model": base64(text bytes), "sample_size": text}``; version =
    ``doc_id % 4``; the size is ``n_chars``. Broken bodies: ``doc_id % 37 = 0`` a size
    that is no number, ``% 41`` a negative size, ``% 43`` no model, ``% 47`` a model
    that is not base64. Identical texts give identical uploads.
    """
    d = F.col("doc_id")
    size = (F.when(d % 37 == 0, F.lit("n/a")).when(d % 41 == 0, F.lit("-4"))
            .otherwise(F.col("n_chars").cast("string")))
    model = (F.when(d % 43 == 0, F.lit(None)).when(d % 47 == 0, F.lit("*not base64*"))
             .otherwise(F.base64(F.encode("text", "UTF-8"))))
    body = F.to_json(F.struct(model.alias("model"), size.alias("sample_size")))
    return documents.select("doc_id", (d % 4).cast("int").alias("version"), body.alias("body"))


def request_log(rounds: DataFrame) -> DataFrame:
    """Request side of round events: the claimed and the server's version and its state.

    The server's version is ``event_id div 1000``; the claim is one behind for
    ``event_id % 5 = 0``, one ahead for ``% 7 = 0``; a merge runs for ``% 46 = 0``, an
    evaluation for ``% 46 = 23``; the model is missing for ``% 29 = 0``.
    """
    eid = F.col("event_id")
    server = F.floor(eid / 1000).cast("int")
    offset = F.when(eid % 5 == 0, -1).when(eid % 7 == 0, 1).otherwise(0)
    return rounds.select("*", (server + offset).alias("claimed_version"),
                         server.alias("server_version"), (eid % 46 == 0).alias("merging"),
                         (eid % 46 == 23).alias("evaluating"), (eid % 29 != 0).alias("exists"))


def live_requests(rounds: DataFrame) -> DataFrame:
    """Request side of round events for the live controller, without any server version.

    A client claims version ``(event_id * 31 + client_id) % (event_id div 500 + 1)``: old
    clients stay, newer versions come up over time. The model is missing for ``event_id %
    29 = 0``. If an upload closes a round, merging takes ``event_id % 4`` times 40 minutes
    and evaluating ``event_id % 3`` times 30 minutes. The uploaded model is the vector of
    id ``event_id % 500``.
    """
    eid = F.col("event_id")
    newest = F.floor(eid / 500) + 1
    return rounds.select("*", ((eid * 31 + F.col("client_id")) % newest).cast("int")
                         .alias("claimed_version"), (eid % 29 != 0).alias("exists"),
                         (eid % 4 * 2_400_000_000).alias("merge_us"),
                         (eid % 3 * 1_800_000_000).alias("evaluate_us"),
                         (eid % 500).alias("model_id"))


def status_documents(rounds: DataFrame) -> DataFrame:
    """A status document before each upload: ``(event_id, client_id, sample_size, document)``."""
    uploads = rounds.filter(F.col("op") == "upload")
    eid = F.col("event_id")
    sizes = F.create_map(F.lit("c1"), eid % 11, (F.col("client_id") % 3).cast("string"), eid % 5)
    doc = F.to_json(F.struct((eid % 9).cast("int").alias("version"),
                             (eid % 2 == 0).alias("merging"), (eid % 3 == 0).alias("evaluating"),
                             sizes.alias("sample_sizes")))
    return uploads.select("event_id", "client_id", "sample_size", doc.alias("document"))
