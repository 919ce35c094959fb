"""The ingestion jobs over a store: reruns, split batches, write-backs."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobsignal import schemas as S
from jobsignal.plans import datasets as T
from jobsignal.plans import jobs
from jobsignal.sources.bodies import with_body
from jobsignal.sources.store import Store

SF = "/root/testdata/sf0.001"
TABLES = ["raw_messages", "vacancies", "vacancy_data", "vacancy_data_vacancies_links", "vacancy_web", "statistic",
          "service", "quarantine"]
RUN = datetime(2025, 6, 1, 12)


def rows(store, table):
    return sorted(map(tuple, store.read(table).collect()), key=repr)


def counts(df):
    return {r.label: r.n for r in df.collect()}


@pytest.fixture(scope="module")
def chat_store(spark, tmp_path_factory):
    store = Store(spark, str(tmp_path_factory.mktemp("chat")))
    return store, counts(jobs.ingest_chat(store, T.chat(spark, SF)))


def test_chat_counters(chat_store):
    store, first = chat_store
    assert first["TELEGRAM"] == first["TG_RAW added"] == store.read("raw_messages").count()
    assert first["TG_VACANCY added"] == store.read("vacancies").count()
    assert first["TG_URL added"] == store.read("vacancy_web").count()
    assert "TG_RAW updated" not in first and first["TG_URL updated"] > 0


def test_rerun_changes_only_counters(spark, chat_store):
    store, first = chat_store
    before = {t: rows(store, t) for t in TABLES}
    again = counts(jobs.ingest_chat(store, T.chat(spark, SF)))
    assert {t: rows(store, t) for t in TABLES} == before
    assert again["TG_RAW updated"] == first["TG_RAW added"] and "TG_RAW added" not in again


def test_one_batch_equals_two(spark, chat_store, tmp_path):
    store, _ = chat_store
    split = Store(spark, str(tmp_path / "split"))
    chat, cut = T.chat(spark, SF), F.col("date") < F.lit("1998-01-01").cast("timestamp_ntz")
    jobs.ingest_chat(split, chat.where(cut))
    jobs.ingest_chat(split, chat.where(~cut))
    for table in TABLES:
        assert rows(split, table) == rows(store, table), table


def test_uncommitted_run_is_invisible(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.stage("service", spark.createDataFrame([("a", "x")], "raw_key string, text string"))
    assert store.read("service").count() == 0
    store.commit()
    assert store.read("service").count() == 1
    other = Store(spark, str(tmp_path / "s"))
    store.commit()
    with pytest.raises(Exception):
        other.commit()


def test_new_messages_start_at_the_mark(spark, tmp_path):
    """Message numbers grow with time; a run reads the mark's messages again and none before them."""
    from pyspark.sql import Window
    store, full = Store(spark, str(tmp_path / "s")), Store(spark, str(tmp_path / "full"))
    place = F.row_number().over(Window.orderBy("date", "message_id")).cast("bigint")
    chat = T.chat(spark, SF).where("message_id < 1500").withColumn("message_id", place).withColumn("date", F.expr("date + interval 60 years"))
    cut = F.col("message_id") <= 200
    first = counts(jobs.ingest_new_chat(store, chat.where(cut)))
    second = counts(jobs.ingest_new_chat(store, chat))
    total = counts(jobs.ingest_chat(full, chat))["TELEGRAM"]
    assert first["TELEGRAM"] == 200 and total - 200 < second["TELEGRAM"] < total - 150
    assert second["TG_RAW added"] == total - 200
    for table in TABLES:
        assert rows(store, table) == rows(full, table), table


def test_new_rows_without_date_or_id_are_quarantined(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    chat = T.chat(spark, SF).where("message_id < 40").withColumn("date", F.expr("date + interval 60 years"))
    jobs.ingest_new_chat(store, chat)
    least = chat.agg(F.min("message_id")).first()[0]
    odd = chat.limit(1).withColumn("message_id", F.lit(None).cast("bigint")).unionByName(
        chat.where(F.col("message_id") == least).withColumn("date", F.lit(None).cast("timestamp_ntz")))
    mails = T.mails(spark, SF).limit(3).select("email_uid", F.expr("date + interval 60 years").alias("date"), F.lit("x").alias("text"), "html")
    undated = mails.limit(1).withColumn("email_uid", F.lit(-7).cast("bigint")).withColumn("date", F.lit(None).cast("timestamp_ntz"))
    for _ in range(2):
        jobs.ingest_new_chat(store, chat.unionByName(odd))
        jobs.ingest_new_mail(store, mails.unionByName(undated))
    found = [r.raw_key for r in store.read("quarantine").where("reason = 'missing_date'").collect()]
    assert sorted(found, key=str) == sorted([None, f"chat-{least}", "mail--7"], key=str)


def test_stream_into_the_store(spark, chat_store, tmp_path):
    """Several micro-batches over two starts, and a replay of the newest rows, give the state of one batch run."""
    from jobsignal.streaming import ingest as streams
    full, _ = chat_store
    landing, store, chat = str(tmp_path / "landing"), Store(spark, str(tmp_path / "s")), T.chat(spark, SF)
    early = F.col("date") < F.lit("1995-01-01").cast("timestamp_ntz")
    run = lambda: streams.ingest_into_store(
        streams.read_landing(spark, landing, chat.schema, 1), store, str(tmp_path / "checkpoint"), jobs.ingest_chat)
    chat.where(early).coalesce(1).write.parquet(landing)
    run()
    chat.where(~early).coalesce(1).write.mode("append").parquet(landing)
    run()
    chat.orderBy(F.desc("date"), F.desc("message_id")).limit(30).coalesce(1).write.mode("append").parquet(landing)
    run()
    for table in TABLES:
        assert rows(store, table) == rows(full, table), table


def test_dead_run_stays_invisible(spark, tmp_path):
    """A run that dies after staging is never read, also when a later run over other tables commits."""
    path = str(tmp_path / "s")
    dead = Store(spark, path)
    dead.stage("service", spark.createDataFrame([("dead", "x")], "raw_key string, text string"))
    alive = Store(spark, path)
    alive.stage("quarantine", spark.createDataFrame([("a", 0, "r", "p")], "raw_key string, part_no int, reason string, payload string"))
    alive.commit()
    assert alive.read("service").count() == 0 and alive.read("quarantine").count() == 1
    with pytest.raises(Exception):
        dead.commit()


def test_two_writers_keep_their_own_folders(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "raw_key string, text string"
    one, two = Store(spark, path), Store(spark, path)
    one.stage("service", spark.createDataFrame([("one", "x")], schema))
    two.stage("service", spark.createDataFrame([("two", "x")], schema))
    one.commit()
    assert [r.raw_key for r in one.read("service").collect()] == ["one"]


def test_lost_race_can_be_run_again(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "raw_key string, text string"
    one, two = Store(spark, path), Store(spark, path)
    one.stage("service", spark.createDataFrame([("one", "x")], schema))
    two.stage("statistic", two.read("statistic"))
    one.commit()
    with pytest.raises(RuntimeError, match="another writer"):
        two.commit()
    two.stage("quarantine", two.read("quarantine"))
    assert two.commit() == 2
    assert set(two.manifest()) == {"service", "quarantine"}  # what was staged for the lost run is gone, the winner's stays
    assert [f.name for f in (tmp_path / "s" / "_commits").iterdir() if f.name.startswith(".run") and f.suffix != ".crc"] == []


@pytest.mark.parametrize("left", [b"", b'{"service": {"": ["service/run'])
def test_broken_manifest_is_passed_over(spark, tmp_path, left):
    path, schema = str(tmp_path / "s"), "raw_key string, text string"
    store = Store(spark, path)
    store.stage("service", spark.createDataFrame([("one", "x")], schema))
    store.commit()
    (tmp_path / "s" / "_commits" / "run-2").write_bytes(left)
    again = Store(spark, path)
    assert again.committed() == 1 and [r.raw_key for r in again.read("service").collect()] == ["one"]
    again.stage("service", spark.createDataFrame([("two", "x")], schema))
    assert again.commit() == 3
    assert [r.raw_key for r in store.read("service").collect()] == ["two"]
    assert store.expire(keep=1) == 1 and store.committed() == 3


def files_of(store, table):
    """Data files that the newest manifest leads to, by partition, with size and time."""
    root, found = Path(store.path), {}
    for part, folders in store.manifest()[table].items():
        found[part] = sorted((str(f.relative_to(root)), f.stat().st_size, f.stat().st_mtime_ns) for folder in folders for f in (root / folder / part).glob("*.parquet"))
    return found


def test_small_batch_leaves_other_partitions_alone(spark, tmp_path):
    """One message in a hundred, all of one month, is read again: files of all other months stay as they are."""
    store = Store(spark, str(tmp_path / "s"))
    chat = T.chat(spark, SF)
    jobs.ingest_chat(store, chat)
    months = [r[0] for r in chat.groupBy(F.date_format("date", "yyyy-MM").alias("m")).count().where("count > 3").orderBy("m").limit(9).collect()]
    assert len(months) == 9
    before = {t: files_of(store, t) for t in S.PARTITIONS}
    texts = files_of(store, "bodies")
    old = {t: rows(store, t) for t in S.PARTITIONS}
    again = chat.where(F.date_format("date", "yyyy-MM") == months[4])
    assert again.count() * 50 < chat.count()
    jobs.ingest_chat(store, again)
    for table in S.PARTITIONS:
        after = files_of(store, table)
        assert set(after) == set(before[table]) and len(after) > 8, table
        changed = {part for part in after if after[part] != before[table][part]}
        assert changed <= {part for part in after if part.endswith(months[4])}, table
    assert len(files_of(store, "raw_messages")) > 60 and set(files_of(store, "bodies")[""]) >= set(texts[""])
    for table in S.PARTITIONS:
        assert rows(store, table) == old[table], table


def test_message_that_moves_to_another_month(spark, tmp_path):
    """A row whose partition changes leaves nothing behind in the old one."""
    store = Store(spark, str(tmp_path / "s"))
    chat = T.chat(spark, SF).where("message_id < 60")
    jobs.ingest_chat(store, chat)
    one = chat.orderBy("message_id").limit(1).withColumn("date", F.expr("date + interval 40 days"))
    jobs.ingest_chat(store, one)
    found = store.read("raw_messages")
    assert found.count() == chat.count() and found.join(one, ["message_id", "date"]).count() == 1


def test_texts_are_stored_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    chat = T.chat(spark, SF).where("message_id < 200").withColumn("text", F.when(F.col("message_id") % 2 == 0, F.lit("Same text")).otherwise(F.col("text")))
    for batch in (chat.where("message_id < 150"), chat.where("message_id >= 100")):
        jobs.ingest_chat(store, batch)
    texts = store.read("bodies")
    assert texts.count() == texts.select("body").distinct().count() == chat.select("text").distinct().count()
    read = with_body(store.read("raw_messages"), texts, "text_key", "text").select("message_id", "text")
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, chat.select("message_id", "text").collect()))


def test_urls_that_turn_out_to_be_one_opening(spark, tmp_path):
    """Pages naming another url: one row per opening, aliases kept, later upserts and fetches touch that row."""
    from jobsignal.operators import fetching
    row = lambda url, key, parsed=None: (url, url, bytearray(b"k"), datetime(2025, 1, 1), 200, parsed, key)
    schema = S.TABLES["vacancy_web"]
    urls = spark.createDataFrame([row("u-long", "a"), row("u", "b"), row("v-x", "c"), row("v-y", "d"), row("w", "e")], schema)
    parsed = spark.createDataFrame([("u-long", "u"), ("v-x", "v"), ("v-y", "v"), ("w", "w"), ("z-old", None)], "page_url string, url string")
    done = fetching.apply_web_parse(urls, parsed, datetime(2025, 6, 1))
    got = sorted((r.url, r.canonical_url, r.parsing_date is not None, r.data_hash) for r in done.collect())
    assert got == [("u", "u", True, "a"), ("v", "v", True, "d"), ("w", "w", True, "e")]
    known = fetching.aliases(spark.createDataFrame([("t", "u-long"), ("s", "q")], S.TABLES["url_aliases"]), parsed)
    assert sorted(map(tuple, known.collect())) == [("s", "q"), ("t", "u"), ("u-long", "u"), ("v-x", "v"), ("v-y", "v")]
    batch = fetching.resolve(spark.createDataFrame([("u-long", 1), ("t", 2), ("w", 3)], "url string, n int"), known)
    assert sorted(map(tuple, batch.collect())) == [("u", 1), ("u", 2), ("w", 3)]


def test_expire_keeps_what_is_read(spark, tmp_path):
    store, schema = Store(spark, str(tmp_path / "s")), "raw_key string, text string"
    for i in range(4):
        store.stage("service", spark.createDataFrame([(str(i), "x")], schema))
        store.commit()
    assert store.expire(keep=1) == 3
    assert [r.raw_key for r in store.read("service").collect()] == ["3"]
    store.stage("service", spark.createDataFrame([("4", "x")], schema))
    assert store.commit() == 5


def test_disagreeing_sources_keep_their_numbers(spark):
    """A number written by two sources is the newer one; texts keep all values."""
    from jobsignal import schemas as S
    from jobsignal.operators import reshape
    ids = S.ATTR_IDS
    rows = [("k", ids["salary_from"], "1000", "2024-01-01"), ("k", ids["salary_from"], "2000", "2024-01-02"),
            ("k", ids["position"], "Dev", "2024-01-01"), ("k", ids["position"], "Data dev", "2024-01-02")]
    links = spark.createDataFrame(rows, "data_hash string, attr_id int, attr_value string, written string")
    row = reshape.typed(reshape.to_wide(links, newest=["written"])).first()
    assert (row.salary_from, row.position) == (2000.0, "Data dev, Dev")
    assert reshape.vac_attr(links).first().attrs[ids["salary_from"]] == ["1000", "2000"]


def _shuffles(df):
    """Keys of the shuffles of a frame as planned, before anything runs."""
    import re
    return re.findall(r"Exchange (?:hashpartitioning\((.*?), \d+\)|(\w+))", df._jdf.queryExecution().executedPlan().toString())


def _links(n):
    """Links of few vacancies, with several values of an attribute, repeated links and missing values."""
    import random
    pick = random.Random(7)
    text = lambda: pick.choice(["a", "b", "1000", "2000", "x" * 16, "x" * 40 + str(pick.randrange(3)), None, ""])
    return [(pick.choice(["k1", "k2", "k3", "k4", None]), pick.choice([1, 2, 7, 8, 16]), text(), f"2024-01-0{pick.randrange(1, 4)}") for _ in range(n)]


def test_wide_rows_against_plain_ones(spark):
    """Attributes with one value, with several and with none, by vacancy."""
    from jobsignal.operators import reshape
    links = _links(60) + [("one", 1, "Dev", "2024-01-01"), ("one", 7, "100", "2024-01-01"), ("void", 2, None, "2024-01-01")]
    df = spark.createDataFrame(links, "data_hash string, attr_id int, attr_value string, written string")
    for newest in (None, ["written"]):
        got = {r.data_hash: r.asDict() for r in reshape.to_wide(df, newest=newest).collect()}
        assert set(got) == {k for k, *_ in links}
        for key, row in got.items():
            for name in S.STORED_ATTRS:
                own = [(at, v) for k, i, v, at in links if k == key and i == S.ATTR_IDS[name]]
                if newest and name in S.NUMERIC_ATTRS:
                    want = max(own, key=lambda p: (p[0], p[1] is not None, p[1] or ""))[1] if own else None
                else:
                    want = ", ".join(sorted({v for _, v in own if v is not None})) if own else None
                assert row[name] == want, (key, name, own)


def test_attributes_of_a_vacancy_are_shuffled_once(spark):
    from jobsignal.operators import reshape
    links = _links(80)
    df = spark.createDataFrame(links, "data_hash string, attr_id int, attr_value string, written string")
    attrs = reshape.vac_attr(df)
    assert [keys.partition("#")[0] for keys, _ in _shuffles(attrs)] == ["data_hash"]
    want = {}
    for key, i, value, _ in links:
        want.setdefault(key, {}).setdefault(i, set()).update([] if value is None else [value])
    assert {r.data_hash: r.attrs for r in attrs.collect()} == {k: {i: sorted(v) for i, v in own.items()} for k, own in want.items()}


def test_links_are_appended_by_vacancy(spark):
    """New links once, known ones not again, incomplete ones always; each side is shuffled once, by vacancy alone."""
    from jobsignal.operators import merge
    schema = "data_hash string, attr_id int, attr_value string"
    stored, batch = [r[:3] for r in _links(40)], [r[:3] for r in _links(200)[100:]] + [("k1", None, "a"), ("k1", None, "a")]
    stored += [("k1", None, "a")]
    both = merge.append_links(spark.createDataFrame(stored, schema), spark.createDataFrame(batch, schema))
    hashed = [keys for keys, _ in _shuffles(both) if keys]
    assert len(hashed) == 2 and all(keys.startswith("data_hash#") and "," not in keys for keys in hashed)
    want = stored + [r for r in dict.fromkeys(batch) if None in r or r not in stored]
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(want, key=repr)


def test_inputs_are_shuffled_before_their_texts_are_made(spark):
    """The texts of messages and mails never travel: the last shuffle deals out names and numbers by message."""
    from jobsignal.sources import fixtures
    for build in (fixtures.chat, fixtures.mail):
        plan = build(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert _shuffles(build(spark, SF))[0][0].startswith("o_orderkey") and plan.index("collect_list") < plan.index("Exchange hashpartitioning(o_orderkey")
        below = plan[plan.index("Exchange hashpartitioning(o_orderkey"):]
        assert "Exchange" not in plan[:plan.index("Exchange hashpartitioning(o_orderkey")] and "djinni" not in below and "collect_list" not in below


def test_delete_messages(spark, chat_store, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    jobs.ingest_chat(store, T.chat(spark, SF))
    keys = store.read("vacancies").select("raw_key").distinct().orderBy("raw_key").limit(20).cache()
    hashes = store.read("vacancies").join(keys, "raw_key").select("data_hash").cache()
    assert hashes.count() >= 20
    before = store.read("raw_messages").count()
    left = counts(jobs.delete_messages(store, keys))
    assert left["raw_messages"] == before - 20 == store.read("raw_messages").count()
    for table in ("vacancies", "vacancy_data_vacancies_links", "vacancy_web"):
        assert store.read(table).join(hashes, "data_hash", "left_semi").count() == 0


def test_mail_then_web(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    mails = T.mails(spark, SF).withColumn("text", F.lit(""))
    first = counts(jobs.ingest_mail(store, mails))
    bad = store.read("quarantine").groupBy("reason").count().collect()
    assert [r.reason for r in bad] == ["short_details"]
    assert first["EMAIL_VACANCY added"] == store.read("vacancies").count()

    flat = jobs.report(store)
    before = {name: flat.where(f"{name} IS NOT NULL").count() for name in ("salary_from", "salary_to", "experience")}
    wanted = jobs.urls_to_fetch(store)
    assert wanted.count() == store.read("vacancy_web").count()
    log = T.pages(spark, SF).join(wanted, "url").select("url", F.lit(200).alias("status"), "html")
    fetched = counts(jobs.ingest_fetches(store, log, RUN))
    assert fetched == {"WEB_URL updated": log.count()}
    assert jobs.urls_to_fetch(store).count() == 0

    done = counts(jobs.parse_pages(store, datetime(2025, 6, 1, 13)))
    assert done["WEB_VACANCY_PARSED"] == log.count()
    urls = store.read("vacancy_web")
    assert urls.where("parsing_date IS NULL").count() == 0
    assert jobs.parse_pages(store, datetime(2025, 6, 1, 14)).collect()[0].n == 0
    # Pages without canonical link are quarantined and keep their url.
    lost = store.read("quarantine").where("reason = 'missing_url'").count()
    assert lost == log.where(~F.contains("html", F.lit("canonical"))).count() > 0
    assert store.read("vacancy_data").where("attr_source_id = 1").count() > 0

    # Seeing the mails again resets the pages of known urls.
    again = counts(jobs.ingest_mail(store, mails))
    assert again["EMAIL_URL updated"] >= first["EMAIL_URL added"]
    assert store.read("vacancy_web").where("page_key IS NOT NULL").count() == 0

    flat = jobs.report(store)
    assert flat.count() == store.read("vacancies").count()
    numbers = {name: flat.where(f"{name} IS NOT NULL").count() for name in before}
    assert all(numbers[name] >= n for name, n in before.items()), (before, numbers)
    assert flat.where("main_tech IS NOT NULL AND position IS NOT NULL").count() > 0
