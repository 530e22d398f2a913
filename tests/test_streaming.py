
from strata import schemas as S
from strata.sinks import keyed
from strata.sinks.store import TableStore
from strata.streaming import EpochSink, land_increments
from conftest import rows


def test_incremental_landing_sees_only_new_files(spark, tmp_lake):
    spec = S.TableSpec("t", "ev", (S.Col("k", "int"), S.Col("v", "string"), S.Col("w", "int")), key=("k",))
    store = TableStore(spark, tmp_lake + "/lake")
    seen = []

    def sink(batch, epoch):
        seen.append(batch.count())
        store.upsert(spec, batch, None, keyed.LAST, ["w"])

    land = tmp_lake + "/landing"
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, w int").write.mode("append").json(land)
    land_increments(spark, land, spec.struct, sink, tmp_lake + "/ckpt")
    spark.createDataFrame([(2, "c", 2), (3, "d", 2), (3, "e", 3)], "k int, v string, w int").write.mode("append").json(land)
    land_increments(spark, land, spec.struct, sink, tmp_lake + "/ckpt")
    land_increments(spark, land, spec.struct, sink, tmp_lake + "/ckpt")   # nothing new: no batch
    assert seen == [2, 3]
    assert rows(store.read(spec)) == [(1, "a", 1), (2, "c", 2), (3, "e", 3)]


def test_a_replayed_batch_appends_unkeyed_rows_once(spark, tmp_lake):
    """A batch is handed over again after each point at which it can have failed."""
    spec = S.TableSpec("t", "ev", (S.Col("k", "int"), S.Col("v", "string"), S.Col("w", "int")), key=("k",))
    batch = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (1, "b", 1)], spec.struct)
    for killed in (False, True):
        store = TableStore(spark, f"{tmp_lake}/lake-{killed}")

        def write(store, spec, rows):
            if state["killed"]:
                state["killed"] = False
                raise RuntimeError("killed between the two writes")
            store.upsert(spec, rows)

        state = {"killed": killed}
        sink = EpochSink(store, spec, "s", write)
        try:
            sink(batch, 0)
        except RuntimeError:
            pass
        sink(batch, 0)
        sink(batch, 0)
        assert rows(sink.read()) == rows(batch)
        sink(batch, 1)                                              # another batch's rows are rows of their own
        EpochSink(store, spec, "other", write)(batch, 0)
        assert sink.read().filter("k IS NULL").count() == 6 and sink.read().filter("k = 1").count() == 1
