"""The store of postings that were surfaced before, as a versioned table.

All look-ups of a run's classification see the version from before the run. A posting is matched by
the first of its sorted keys that any entry holds; where several entries hold a key, the one put
last owns it. Entries are put in the order in which a store is written: by first surfacing and
company, then as they were put. Then surfaced postings are recorded in input order, and after them
suppressed ones teach the store their keys; here each look-up sees what the postings before it
left. A posting that finds an entry adds its keys to it and puts it anew, so that it owns all of
its keys from then on; a surfaced one that finds none makes an entry. An entry keeps its first
object id, the best band it was ever shown at, and the union of its keys. Of two entries
with the same object id the one put last stays.

A run is merged without going through it posting by posting. Once a posting has touched a key, that key has an
owner for good, so whether a posting makes an entry, and else by which key it finds one, follows from
the first touch of each key. Whose entry that is was settled by an earlier posting that touched
the key: such references are followed to their ends, twice as far in each round. Only a key that entries of several names
hold can change hands in between; its owner as of a posting is the holder that was put last before,
found on sorted timelines of the holders or of the key, and this is repeated until nothing moves. Each repetition settles at
least the earliest posting that was wrong. No task holds a connected set or all rows of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import band_rank, match_keys, posting_key
from ..tables import settle
from .timeline import latest_before, number
from .visited import applied_companies

ENTRY_DDL = (
    "object_id string, keys array<string>, band string, first_surfaced string, last_surfaced string, surfaced_count bigint, "
    "opened boolean, applied boolean, company_applied boolean, title string, company string, company_host string, put_seq bigint"
)
SURFACED = ("strong", "possible")


#: The place of an entry among all: which is put last, and the order of the written store.
PUT_ORDER = ("first_surfaced", "company", "put_seq")


def empty_store(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ENTRY_DDL)


def from_records(records: DataFrame) -> DataFrame:
    """Entries of a store that was written as JSON lines (record: VARIANT, ord): what is missing takes its default."""
    v = F.col("record")
    text = lambda f, default="": F.coalesce(F.try_variant_get(v, f"$.{f}", "string"), F.lit(default))
    flag = lambda f: F.coalesce(F.try_variant_get(v, f"$.{f}", "boolean"), F.lit(False))
    return records.select(
        text("object_id").alias("object_id"), F.coalesce(F.try_variant_get(v, "$.keys", "array<string>"), F.array().cast("array<string>")).alias("keys"), text("band", "possible").alias("band"),
        text("first_surfaced").alias("first_surfaced"), text("last_surfaced").alias("last_surfaced"), F.coalesce(F.try_variant_get(v, "$.surfaced_count", "bigint"), F.lit(1)).alias("surfaced_count"),
        *[flag(f).alias(f) for f in ("opened", "applied", "company_applied")], *[text(f).alias(f) for f in ("title", "company", "company_host")], F.col("ord").alias("put_seq"),
    )


def to_lines(store: DataFrame) -> DataFrame:
    """(value): the entries as JSON lines, in the order in which a store is written."""
    fields = [c.split(" ")[0] for c in ENTRY_DDL.split(", ")][:-1]
    return in_order(store).select(F.to_json(F.struct(*fields)).alias("value"))


def owners(store: DataFrame) -> DataFrame:
    """(key, owner): the entry put last of those that hold the key."""
    return store.select("object_id", *PUT_ORDER, F.explode("keys").alias("key")).groupBy("key").agg(F.max_by("object_id", F.struct(*PUT_ORDER)).alias("owner"))


def look_up(postings: DataFrame, store: DataFrame) -> DataFrame:
    """``postings`` (with ord and keys) with owner: the entry of its first key that has one."""
    each = postings.select("ord", F.explode("keys").alias("key"))
    hit = each.join(owners(store), "key").groupBy("ord").agg(F.min_by("owner", "key").alias("owner"))
    return postings.join(hit, "ord", "left")


def classify(screened: DataFrame, store: DataFrame) -> DataFrame:
    """Surfaced bands only, with keys, owner and action: new, promoted or suppressed."""
    keyed = screened.where(F.col("band").isin(*SURFACED)).withColumn("keys", match_keys(F.col("object_id"), F.col("alternate_object_ids"), F.col("cluster_key")))
    found = look_up(keyed, store)
    known = store.select(F.col("object_id").alias("owner"), F.col("band").alias("known_band"))
    found = found.join(known, "owner", "left")
    action = F.when(F.col("known_band").isNull(), "new").when(band_rank(F.col("band")) > band_rank(F.col("known_band")), "promoted").otherwise("suppressed")
    return found.withColumn("action", action)


def shortlist(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("action") != "suppressed")


def label(store: DataFrame, opened: DataFrame, applied_hosts: DataFrame) -> DataFrame:
    """Entries with opened, applied and company_applied raised by the visit log; nothing is ever lowered.

    ``opened`` is (key, applied) of posting keys; any id an entry is known under counts.
    """
    ids = store.select("object_id", F.explode(F.array_union(F.array(F.concat(F.lit("id:"), F.col("object_id"))), F.col("keys"))).alias("k")).where(F.startswith("k", F.lit("id:")))
    marks = ids.select("object_id", posting_key(F.substring("k", F.lit(4), F.length("k"))).alias("key")).join(opened, "key")
    marks = marks.groupBy(F.col("object_id").alias("_id")).agg(F.bool_or(F.coalesce("applied", F.lit(False))).alias("_applied"))
    flags = applied_companies(store.select("object_id", "company_host").distinct(), applied_hosts).select(F.col("object_id").alias("_c"), F.col("company_applied").alias("_company"))
    out = store.join(marks, F.col("object_id") == F.col("_id"), "left").join(flags, F.col("object_id") == F.col("_c"), "left")
    return out.withColumns(
        {
            "opened": F.col("opened") | F.col("_id").isNotNull(),
            "applied": F.col("applied") | F.coalesce("_applied", F.lit(False)),
            "company_applied": F.col("company_applied") | F.coalesce("_company", F.lit(False)),
        }
    ).select(*store.columns)


def label_counts(store: DataFrame) -> DataFrame:
    return store.agg(F.count_if("opened").alias("opened"), F.count_if("applied").alias("applied"), F.count_if("company_applied").alias("company_applied"))


def _follow(pointers: DataFrame) -> DataFrame:
    """(t, name) of ``pointers`` (t, name, prior): where the name is missing it is that of the posting ``prior``, which is an earlier one."""
    while True:
        open_ = pointers.where("name is null")
        if open_.isEmpty():
            return pointers.select("t", "name")
        via = pointers.select(F.col("t").alias("_t"), F.col("name").alias("_name"), F.col("prior").alias("_prior"))
        moved = open_.join(via, F.col("prior") == F.col("_t")).select("t", F.col("_name").alias("name"), F.col("_prior").alias("prior"))
        pointers = settle(pointers.where("name is not null").union(moved), "pointers")


def _started(named: DataFrame, starts: DataFrame) -> DataFrame:
    """``named`` (t, name) with start: when the entry that has the name at t was made; 0 for the store's."""
    several = starts.groupBy(F.col("name").alias("_n")).agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("_s"))
    found = named.join(several, F.col("name") == F.col("_n"))
    once = found.where("n = 1").select("t", "name", F.col("_s").alias("start"))
    if several.where("n > 1").isEmpty():
        return once
    again = latest_before(found.where("n > 1").select(F.col("name").alias("k"), "t"), starts.select(F.col("name").alias("k"), F.col("start").alias("t")), inclusive=True)
    return once.union(again.select("t", F.col("k").alias("name"), F.col("mark").alias("start")))


def _last_put(asks: DataFrame, holders: DataFrame, placed: DataFrame) -> DataFrame:
    """(t, mark) of ``asks`` (t, key): the latest t of ``placed`` (t, name, start) before it at which an entry was put that held the key by then.

    ``holders`` (key, name, start, since) tells since when. A key either asks each of its holders for its last put, or has the puts of all of
    them on a timeline of its own, whichever makes fewer rows: a key with many asks and as many holders grows with their sum.
    """
    wanted = asks.groupBy(F.col("key").alias("_k")).agg(F.count(F.lit(1)).alias("asks"))
    puts = placed.groupBy(F.col("name").alias("_n"), F.col("start").alias("_s")).agg(F.count(F.lit(1)).alias("puts"))
    among = holders.join(wanted, F.col("key") == F.col("_k")).join(puts, (F.col("name") == F.col("_n")) & (F.col("start") == F.col("_s")))  # one that was never put owns nothing
    among = settle(among.select("_k", "name", "start", "since", "asks", "puts"), "holders")
    way = among.groupBy("_k").agg((F.sum("puts") < F.max("asks") * F.count(F.lit(1))).alias("line"))
    way = settle(way.withColumnRenamed("_k", "_w"), "ways")
    of = lambda line: way.where(F.col("line") == line)
    # By holder: pairs of an ask and a holder.
    each = asks.join(among.join(of(False), F.col("_k") == F.col("_w"), "left_semi"), (F.col("key") == F.col("_k")) & (F.col("since") < F.col("t")))
    entry = F.struct("name", "start").alias("k")
    found = latest_before(each.select(entry, "t"), placed.select(entry, "t")).groupBy("t").agg(F.max("mark").alias("mark"))
    # By key: pairs of a holder and a put of it.
    line = among.join(of(True), F.col("_k") == F.col("_w"), "left_semi").select("_k", F.col("name").alias("_n"), F.col("start").alias("_s"), "since")
    marks = placed.join(line, (F.col("name") == F.col("_n")) & (F.col("start") == F.col("_s")) & (F.col("t") >= F.col("since"))).select(F.col("_k").alias("k"), "t").distinct()
    asked = asks.join(of(True), F.col("key") == F.col("_w"), "left_semi").select(F.col("key").alias("k"), "t")
    return found.union(latest_before(asked, marks).select("t", "mark"))


def resolve(events: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(t, name, start) of each posting of ``events`` (t, object_id, keys): the entry that it makes or finds, by its object id and the
    t at which it was made, 0 for the store's; and (name, start) of all entries of those names."""
    touch = settle(events.select("t", F.explode("keys").alias("key")), "touches")
    first = touch.groupBy("key").agg(F.min("t").alias("first"))
    info = settle(first.join(owners(store), "key", "left"), "keys")
    held = touch.join(info, "key").where("owner is not null or first < t")
    looked = held.groupBy("t").agg(F.min(F.struct("key", "owner", "first")).alias("x"))
    begun = events.select("t", "object_id").join(looked.withColumnRenamed("t", "_t"), F.col("t") == F.col("_t"), "left")
    begun = settle(
        begun.select(
            "t", F.col("x.key").alias("key"), F.when(F.col("x").isNull(), F.col("object_id")).otherwise(F.col("x.owner")).alias("name"),
            F.when(F.col("x.owner").isNull(), F.col("x.first")).alias("prior"), F.col("x.owner").alias("owner"),
        ),
        "begun",
    )
    made = begun.where("key is null").select("name", F.col("t").alias("start"))
    old = store.select(F.col("object_id").alias("name"), F.lit(0).cast("bigint").alias("start")).distinct()
    live = _live(store).select(F.explode("keys").alias("key"), F.col("object_id").alias("name"), F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("since"))
    live = settle(live.join(first.select(F.col("key").alias("_key")), F.col("key") == F.col("_key"), "left_semi"), "holds-before")
    named = _follow(begun.select("t", "name", "prior"))
    while True:
        used = named.select(F.col("name").alias("_used")).distinct()
        starts = settle(made.union(old.join(used, F.col("name") == F.col("_used"), "left_semi")), "starts-of")
        placed = settle(_started(named, starts), "placed")
        holds = settle(touch.join(placed, "t").groupBy("key", "name", "start").agg(F.min("t").alias("since")), "holds")
        names = holds.union(live).select("key", "name").union(info.where("owner is not null").select("key", "owner"))
        hot = settle(names.groupBy("key").agg(F.min("name").alias("a"), F.max("name").alias("b")).where("a <> b").select(F.col("key").alias("_key")), "contested")
        asks = settle(begun.join(hot, F.col("key") == F.col("_key"), "left_semi").select("t", "key"), "asks")
        if asks.isEmpty():
            return placed, starts
        found = _last_put(asks, holds.union(live), placed).select(F.col("t").alias("_t"), "mark")
        moved = begun.join(found, F.col("t") == F.col("_t"), "left").select(
            "t", F.when(F.col("key").isNull(), F.col("name")).when(F.col("mark").isNull(), F.col("owner")).alias("name"),
            F.when(F.col("key").isNotNull(), F.coalesce("mark", F.when(F.col("owner").isNull(), F.col("prior")))).alias("prior"),
        )
        now = _follow(settle(moved, "pointers"))
        if now.join(named.select(F.col("t").alias("_t"), F.col("name").alias("_name")), F.col("t") == F.col("_t")).where("name <> _name").isEmpty():
            return placed, starts
        named = now


def _live(store: DataFrame) -> DataFrame:
    """Of entries with the same object id, the one put last."""
    return store.groupBy("object_id").agg(F.max_by(F.struct(*store.columns), F.struct(*PUT_ORDER)).alias("e")).select("e.*")


def merge(store: DataFrame, classified: DataFrame, today: str) -> DataFrame:
    """The next version of the store."""
    columns = [c.split(" ")[0] for c in ENTRY_DDL.split(", ")]
    top = store.agg(F.coalesce(F.max("put_seq"), F.lit(0))).first()[0]
    late = F.col("action") == "suppressed"
    events = classified.select(
        F.when(late, 2).otherwise(1).alias("phase"), "ord", F.coalesce("object_id", F.lit("")).alias("object_id"), "keys", "band",
        F.coalesce(F.nullif("raw_title", F.lit("")), "title").alias("title"), "company", F.coalesce("company_host", F.lit("")).alias("company_host"),
    )
    events = settle(number(events, [F.col("phase"), F.col("ord"), F.col("object_id")]).withColumnRenamed("n", "t"), "events")
    placed, starts = resolve(events, store)
    # What stays of a name is its last entry.
    last = settle(starts.groupBy(F.col("name").alias("_n")).agg(F.max("start").alias("_s")), "last")
    live = settle(placed.join(last, (F.col("name") == F.col("_n")) & (F.col("start") == F.col("_s"))).select("t", "name", "start").join(events.drop("ord"), "t"), "work")
    taught = live.select("name", F.explode("keys").alias("key"))
    shown = F.col("phase") == 1
    work = live.groupBy("name").agg(
        F.max("t").alias("put"), F.count_if(shown).alias("shown"), F.max_by(F.struct("band", band_rank(F.col("band")).alias("rank")), F.when(shown, F.struct(band_rank(F.col("band")), -F.col("t")))).alias("best"),
    )
    text, flag, none = F.lit(None).cast("string"), F.lit(False), F.array().cast("array<string>")
    new = live.where("t = start").select(
        "name", "object_id", none.alias("keys"), "band", F.lit(today).alias("first_surfaced"), text.alias("last_surfaced"), F.lit(0).cast("bigint").alias("surfaced_count"),
        *[flag.alias(c) for c in ("opened", "applied", "company_applied")], "title", "company", "company_host", F.col("t").alias("put_seq"),
    )
    kept = _live(store).join(last.where("_s = 0"), F.col("object_id") == F.col("_n")).select(F.col("object_id").alias("name"), *columns)
    base = settle(new.union(kept), "bases")
    keys = taught.union(base.select("name", F.explode("keys"))).distinct().groupBy(F.col("name").alias("_k")).agg(F.array_sort(F.collect_list("key")).alias("all"))
    out = base.join(work.withColumnRenamed("name", "_w"), F.col("name") == F.col("_w")).join(keys, F.col("name") == F.col("_k"), "left")
    better = F.col("best.rank") > band_rank(F.col("band"))
    changed = {
        "keys": F.coalesce("all", none), "band": F.when(better, F.col("best.band")).otherwise(F.col("band")), "last_surfaced": F.when(F.col("shown") > 0, F.lit(today)).otherwise(F.col("last_surfaced")),
        "surfaced_count": F.col("surfaced_count") + F.col("shown"), "put_seq": F.lit(top) + F.col("put"),
    }
    made = settle(out.withColumns(changed).select(*columns), "entries")
    if not store.groupBy("object_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():  # only a store that was written elsewhere
        store = _live(store)
    return store.join(last.select("_n"), F.col("object_id") == F.col("_n"), "left_anti").select(*columns).unionByName(made)


def in_order(store: DataFrame) -> DataFrame:
    """The entries in the order in which a store is written."""
    return store.orderBy(*PUT_ORDER)
