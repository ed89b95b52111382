"""events -> vectors mapping: FIXTURES §2 counts, payload round trip, skew-safe rank."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolake.operators.explode import explode_states
from aerolake.operators.ranking import rank_within
from aerolake.operators.validate import with_field_count
from aerolake.plans.inspect import plan_text
from aerolake.plans.queries import curated_all
from aerolake.sources.fixtures import build_payloads, event_vectors, load_table
from support import SF_CHECK


def test_fixture_counts_sf001(spark):
    vec = event_vectors(load_table(spark, SF_CHECK, "events")).cache()
    assert vec.count() == 10_000
    assert vec.select("source_response_time").distinct().count() == 720
    assert vec.agg(F.max("state_position")).first()[0] == 29
    counts = {r[0]: r[1] for r in with_field_count(vec).groupBy("field_count").count().collect()}
    assert counts == {17: 9667, 16: 111, 18: 118, -1: 104}
    assert curated_all(spark, SF_CHECK).select("record_key").distinct().count() == 9667
    # building payloads and exploding them again returns exactly the vectors
    docs = build_payloads(vec.drop("event_id"))
    back = explode_states(docs, base_position_col="base_position").select(
        "source_response_time", "state_position", "state")
    orig = vec.select("source_response_time", "state_position", "state")
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0
    vec.unpersist()


def test_documents_are_gathered_where_their_vectors_are_made(spark):
    events = load_table(spark, SF_CHECK, "events")
    want, vec = event_vectors(events), event_vectors(events, by_response=True)
    assert vec.columns == want.columns and vec.exceptAll(want).count() == 0 and want.exceptAll(vec).count() == 0
    docs, plain = build_payloads(vec), build_payloads(want)
    assert docs.exceptAll(plain).count() == 0 and docs.count() == plain.count() == 720
    shuffles = lambda df: plan_text(df, "simple").count("Exchange hashpartitioning")
    assert shuffles(docs) == shuffles(plain) == shuffles(vec)  # the one by response, and none of whole vectors after it


def test_payload_chunks_bounded(spark):
    vec = event_vectors(load_table(spark, SF_CHECK, "events")).drop("event_id")
    docs = build_payloads(vec, max_states=7)
    assert docs.agg(F.max(F.size("states"))).first()[0] <= 7
    back = explode_states(docs, base_position_col="base_position").select("source_response_time", "state_position", "state")
    orig = vec.select("source_response_time", "state_position", "state")
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0


@settings(max_examples=8, deadline=None)
@given(
    groups=st.lists(st.integers(0, 3), min_size=1, max_size=60),
    width=st.sampled_from([1, 2, 3, 7, 1 << 20]),
)
def test_rank_within_equals_row_number(spark, groups, width):
    rows = [(i * 3 + (g % 2), g) for i, g in enumerate(groups)]  # unique, sparse keys; group 0 often hot
    df = spark.createDataFrame(rows, "k long, g long")
    got = {(r.k, r.pos) for r in rank_within(df, "g", "k", "pos", bucket_width=width).collect()}
    w = Window.partitionBy("g").orderBy("k")
    exp = {(r.k, r.pos) for r in df.withColumn("pos", F.row_number().over(w) - 1).collect()}
    assert got == exp


def test_full_hours_split_into_responses_that_reread_exactly(spark, tmp_dir, monkeypatch):
    """An hour beyond the per-document cap becomes several responses (end of hour + k s);
    landing them and reading the files back gives exactly the vectors (positions per document)."""
    import aerolake.sources.fixtures as fx
    from aerolake.operators.explode import parse_state_elements
    from aerolake.sinks.landing import land_documents
    from aerolake.sources.landing import payload_json
    from aerolake.sources.raw_json import read_raw
    from support import SF_SMALL

    monkeypatch.setattr(fx, "MAX_STATES_PER_PAYLOAD", 5)
    vec = fx.event_vectors(load_table(spark, SF_SMALL, "events")).drop("event_id").cache()
    assert vec.agg(F.max("state_position")).first()[0] == 4
    hours = vec.select(F.expr("source_response_time div 3600").alias("h")).distinct().count()
    assert vec.select("source_response_time").distinct().count() > hours  # some hours needed several responses
    docs = fx.build_payloads(vec, max_states=5)
    base = f"{tmp_dir}/landing"
    land_documents(docs, base, F.timestamp_seconds(F.col("time") + F.lit(45)), payload_json())
    back = explode_states(parse_state_elements(read_raw(spark, base))).select(
        "source_response_time", "state_position", "state")
    orig = vec.select("source_response_time", "state_position", "state")
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0
    vec.unpersist()
