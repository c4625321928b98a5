from pyspark.sql import Row
from pyspark.sql import functions as F

from concord.operators import corpus as C
from concord.sources import files, fixtures
from concord.plans import corpus_job
from table_paths import SF001

WIDE = ("doc_id long, text string, source string, seq int, m1 int, m2 int, m3 int, p1 int, "
        "oh_label int, hateful int, class int, file string")


def wide_rows(spark, rows):
    return spark.createDataFrame([(*r, None) if len(r) == 11 else r for r in rows], WIDE)


def test_onehot_null_vote_and_two_votes_fall_in_no_class(spark):
    df = wide_rows(spark, [
        (1, "a", "onehot", 1, 1, None, 0, 0, None, None, None),   # NULL vote
        (2, "b", "onehot", 1, 1, 1, 0, 0, None, None, None),      # sum 2
        (3, "c", "onehot", 1, 0, 0, 1, 0, None, None, None),      # offensive
        (4, "d", "onehot", 1, 0, 0, 0, 1, None, None, None),      # inoffensive
    ])
    got = {(r.doc_id, r.objectionable) for r in C.tag_classes(df, keep=["doc_id"]).collect()}
    assert got == {(3, 1), (4, 0)}


def test_row_with_both_classes_yields_two_rows(spark):
    df = wide_rows(spark, [(1, "a", "onehot", 1, 1, 0, 0, 1, None, None, None)])
    got = sorted(r.objectionable for r in C.tag_classes(df).collect())
    assert got == [0, 1]


def test_null_and_blank_text_dropped_by_default(spark):
    df = wide_rows(spark, [
        (1, None, "binary", 3, None, None, None, None, None, 1, None),
        (2, "   ", "binary", 3, None, None, None, None, None, 1, None),
        (3, "ok", "binary", 3, None, None, None, None, None, 1, None),
    ])
    assert C.tag_classes(df).count() == 1
    assert C.tag_classes(df, drop_blank=False).count() == 3


def test_dedup_keeps_conflicting_labels_and_collapses_copies(spark):
    df = wide_rows(spark, [
        (1, "same", "binary", 3, None, None, None, None, None, 1, None),
        (2, "same", "binary", 3, None, None, None, None, None, 1, None),
        (3, "same", "ordinal", 4, None, None, None, None, None, None, 2),
    ])
    tagged = C.tag_classes(df)
    corpus = {(r.text, r.objectionable) for r in C.dedupe_corpus(tagged).collect()}
    assert corpus == {("same", 1), ("same", 0)}
    conflicts = C.label_conflicts(tagged.select("text", C.LABEL)).collect()
    assert len(conflicts) == 1 and conflicts[0].n_labels == 2


def test_split_sizes_disjoint_complete_and_stable(spark):
    corpus = corpus_job.corpus(spark, SF001)
    split = C.stratified_split(corpus).cache()
    n = corpus.count()
    assert split.count() == n
    assert split.select("text", C.LABEL).distinct().count() == n
    for label in (0, 1):
        part = split.filter(F.col(C.LABEL) == label)
        k = part.count()
        hold = (3 * k + 9) // 10
        test = (hold + 1) // 2
        sizes = {r.split: r["count"] for r in part.groupBy("split").count().collect()}
        assert sizes.get("train", 0) == k - hold
        assert sizes.get("test", 0) == test
        assert sizes.get("val", 0) == hold - test
    again = C.stratified_split(corpus.repartition(7), bucket_hex=2)
    assert split.select("text", C.LABEL, "split").exceptAll(
        again.select("text", C.LABEL, "split")).count() == 0


def test_csv_round_trip_is_exact(spark, tmp_dir):
    texts = ['he said "hi", then\nleft', "plain", "  lead and trail  ", "", None, '""', '"', " ",
             "\t tab \t", "back\\slash", "a\\\"b", "cr\r\nlf"]
    rows = [Row(text=t, objectionable=i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "text string, objectionable int")
    files.write_csv(df, f"{tmp_dir}/corpus")
    back = files.read_csv(spark, f"{tmp_dir}/corpus", df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows), key=str)
    lines = df.filter("NOT contains(coalesce(text, ''), '\\n')")
    files.write_csv(lines, f"{tmp_dir}/lines")
    back = files.read_csv(spark, f"{tmp_dir}/lines", df.schema)
    assert back.exceptAll(lines).count() == 0 and lines.exceptAll(back).count() == 0


def test_distinct_texts_are_counted_per_file(spark):
    row = lambda i, text, file, label: (i, text, "multifile", 2, None, None, None, None, label,
                                        None, None, file)
    df = wide_rows(spark, [row(1, "x", "a.csv", 1), row(2, "x", "a.csv", 1),
                           row(3, "x", "b.csv", 1), row(4, "y", "b.csv", 0)])
    counts = C.source_counts(C.tag_classes(df, keep=["file"]))
    got = {(r.file, r.objectionable): (r.n_rows, r.n_distinct) for r in counts.collect()}
    assert got == {("a.csv", 1): (2, 1), ("b.csv", 1): (1, 1), ("b.csv", 0): (1, 1)}
    totals = C.running_totals(counts).orderBy("seq", "file").collect()
    assert [(r.cum_offensive, r.cum_inoffensive) for r in totals] == [(1, 0), (2, 1)]


def test_sources_written_as_csv_give_the_same_corpus(spark, tmp_dir):
    wide = corpus_job.wide_sources(spark, SF001)
    frames = {}
    for name in fixtures.SOURCE_NAMES:
        raw = fixtures.raw_source(wide, name)
        path = f"{tmp_dir}/{name}"
        if name == "multifile":
            files.write_csv(raw, path, partition_by=["file"])
            frames[name] = files.read_csv_dir(spark, f"{path}/*", raw.drop("file").schema,
                                              multi_line=True)
        else:
            files.write_csv(raw, path)
            frames[name] = files.read_csv(spark, path, raw.schema, multi_line=True)
    via_csv = C.dedupe_corpus(C.tag_classes(C.normalise_raw(frames)))
    direct = corpus_job.corpus(spark, SF001)
    assert via_csv.exceptAll(direct).count() == 0
    assert direct.exceptAll(via_csv).count() == 0


def test_running_totals_are_cumulative(spark):
    rt = C.running_totals(C.source_counts(corpus_job.tagged(spark, SF001))).orderBy(
        "seq", "file")
    rows = rt.collect()
    acc = 0
    for r in rows:
        acc += r.n_offensive
        assert r.cum_offensive == acc
