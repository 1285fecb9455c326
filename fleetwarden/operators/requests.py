"""Data requests: cohorts, score lists, account enrichment, code batches, request sheets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.times import epoch_seconds, midnight, time_literal
from fleetwarden.operators.lookup import look_up
from fleetwarden.operators.prefix import ranged, sums_before
from fleetwarden.operators.reconcile import update_from
from fleetwarden.session import stored

# Quota, code length, shard width and suffix length, columns that can be enriched.
MAX_CODES_PER_BATCH = 200_000
CODE_LENGTH = 16
SHARD_WIDTH = 1_000_000
SHARD_SUFFIX_LENGTH = 8
ENRICHABLE = ["regip", "acc_country", "gender", "bday", "regdate", "username", "email", "email_v"]
LOG_RETENTION_DAYS, REPORT_RETENTION_DAYS, ARCHIVE_RETENTION_DAYS = 90, 2, 5

SECONDS_PER_DAY = 86_400
CODES_PER_BLOCK = 10_000


# --- cohorts ---------------------------------------------------------------------------------

def churn_cohort(
    users: DataFrame, days_from: int, days_to: int, level_from: int, level_to: int, as_of: str
) -> DataFrame:
    """Users last active from ``days_to + 1`` days ago (included) to ``days_from`` days ago
    (excluded), both at midnight, within the levels, newest first."""
    seen = F.col("last_active_time")
    low = epoch_seconds(midnight(as_of, -(days_to + 1)))
    high = epoch_seconds(midnight(as_of, -days_from))
    return (
        users.filter((seen >= low) & (seen < high) & F.col("level").between(level_from, level_to))
        .select("uid", F.timestamp_seconds(seen).alias("last_login_datetime"), "level")
        .orderBy(F.desc("last_login_datetime"), "uid")
    )


def churn_batch(users: DataFrame, requests: DataFrame, as_of: str) -> DataFrame:
    """:func:`churn_cohort` for all requests at once: (request_id, uid, last login, level).

    requests: (request_id, region, days_from, days_to, level_from, level_to). The windows are
    whole days, so a request becomes one row per day of its window and meets the users by equality
    of (region, day); only the level is left to compare. Requests are small beside the users, and
    a busy day is split by adaptive execution on the users' side.
    """
    today = epoch_seconds(midnight(as_of)) // SECONDS_PER_DAY
    oldest = F.lit(today).cast("bigint") - F.col("days_to") - 1
    newest = F.lit(today).cast("bigint") - F.col("days_from")
    wanted = requests.filter(F.col("days_from") <= F.col("days_to") + 1).select(
        "request_id",
        "region",
        "level_from",
        "level_to",
        F.explode(F.filter(F.sequence(oldest, newest), lambda d: d < newest)).alias("day"),
    )
    seen = F.col("last_active_time")
    active = users.select(
        "uid", "region", "level", "last_active_time",
        F.floor(seen / SECONDS_PER_DAY).cast("bigint").alias("day"),
    )
    return (
        active.join(wanted, ["region", "day"], "inner")
        .filter(F.col("level").between(F.col("level_from"), F.col("level_to")))
        .select("request_id", "uid", F.timestamp_seconds(seen).alias("last_login_datetime"), "level")
    )


# --- scores ----------------------------------------------------------------------------------

def score_list(
    accounts: DataFrame, scores: DataFrame, cap: int, score: str = "harassment_score"
) -> DataFrame:
    """Accounts (acct_id, sum_id) whose score (summoner_id, score) reaches ``cap``.

    The cap is applied before the join; the tables may come from different sources, as Spark reads
    each where it is and broadcasts the filtered scores if their size allows.
    """
    high = scores.filter(F.col(score) >= cap).select(F.col("summoner_id").alias("sum_id"), score)
    return accounts.join(high, "sum_id", "inner").select(F.col("acct_id").alias("uid"), score)


def score_histogram(scores: DataFrame, column: str, width: int) -> DataFrame:
    """Counts in buckets ``floor(x / width) * width``, in bucket order."""
    bucket = (F.floor(F.col(column) / width) * width).cast("bigint")
    return scores.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("row_count")).orderBy("bucket")


def score_batch(
    accounts: DataFrame, scores: DataFrame, requests: DataFrame, score: str = "harassment_score"
) -> DataFrame:
    """:func:`score_list` for all requests (request_id, region, cap) at once.

    Scores below the lowest cap of their region go first, then requests join by region.
    """
    floor_caps = requests.groupBy("region").agg(F.min("cap").alias("_lowest"))
    high = (
        look_up(scores, floor_caps, ["region"])
        .filter(F.col(score) >= F.col("_lowest"))
        .select("region", F.col("summoner_id").alias("sum_id"), score)
    )
    owned = high.join(accounts.select("region", "sum_id", "acct_id"), ["region", "sum_id"], "inner")
    return (
        owned.join(requests.select("request_id", "region", "cap"), "region", "inner")
        .filter(F.col(score) >= F.col("cap"))
        .select("request_id", F.col("acct_id").alias("uid"), score)
    )


def score_histogram_batch(
    scores: DataFrame, requests: DataFrame, column: str = "harassment_score"
) -> DataFrame:
    """:func:`score_histogram` for all requests (request_id, region, width) at once.

    Rows are first counted per (region, finest whole score), so a request meets distinct scores
    of its region and not its rows.
    """
    counted = scores.groupBy("region", F.col(column).alias("_score")).agg(F.count("*").alias("_n"))
    bucket = (F.floor(F.col("_score") / F.col("width")) * F.col("width")).cast("bigint")
    return (
        counted.join(requests.select("request_id", "region", "width"), "region", "inner")
        .groupBy("request_id", bucket.alias("bucket"))
        .agg(F.sum("_n").alias("row_count"))
    )


# --- accounts --------------------------------------------------------------------------------

def shard_of(uid: Column, width: int = SHARD_WIDTH) -> Column:
    """Shard number of an account id, cut toward zero."""
    return F.call_function("div", uid, F.lit(width))


def shard_suffix(shard: Column) -> Column:
    """Eight digits; a number of more digits is an error, as two shards would share a suffix."""
    text = shard.cast("string")
    long = F.raise_error(F.concat(F.lit("no table suffix for shard "), text)).cast("string")
    return F.when(F.length(text) > SHARD_SUFFIX_LENGTH, long).otherwise(F.lpad(text, SHARD_SUFFIX_LENGTH, "0"))


def shard_plan(requested: DataFrame, width: int = SHARD_WIDTH) -> DataFrame:
    """Distinct requested ids with shard, table suffix, and whether first or last of the shard."""
    uids = requested.select("uid").distinct().withColumn("shard", shard_of(F.col("uid"), width))
    ends = uids.groupBy("shard").agg(F.min("uid").alias("_min"), F.max("uid").alias("_max"))
    return look_up(uids, ends, ["shard"]).select(
        "uid",
        "shard",
        shard_suffix(F.col("shard")).alias("suffix"),
        (F.col("uid") == F.col("_min")).alias("is_first"),
        (F.col("uid") == F.col("_max")).alias("is_last"),
    )


def with_shard(accounts: DataFrame, width: int = SHARD_WIDTH) -> DataFrame:
    """Add the ``shard`` column by which account tables are written (``partitionBy('shard')``)."""
    return accounts.withColumn("shard", shard_of(F.col("uid"), width))


def shard_lookup(
    requested: DataFrame, profiles: DataFrame, accounts: DataFrame, width: int = SHARD_WIDTH
) -> DataFrame:
    """Profile and account of the requested ids, read from the shards that hold them.

    ``profiles`` and ``accounts`` carry ``shard``. On tables partitioned by ``shard`` on disk the scans are
    pruned at run time to the shards of the requested ids: where these are few enough to be broadcast,
    the broadcast itself names the shards; otherwise all shards are read, with the same result.
    """
    wanted = with_shard(requested.select("uid").distinct(), width)
    # Says no more than that the id is given; as a comparison it lets the optimiser prune by the join.
    wanted = wanted.filter(F.col("uid") >= F.lit(-(1 << 63)))
    found = profiles.join(wanted, ["shard", "uid"], "left_semi")
    names = accounts.join(wanted, ["shard", "uid"], "left_semi")
    return found.join(names, ["shard", "uid"], "inner").drop("shard")


def updatable_columns(target: DataFrame, known: Sequence[str] = tuple(ENRICHABLE)) -> list[str]:
    """The known columns that the target has, as it spells them; an error when there are none."""
    present = {c.lower(): c for c in target.columns}
    found = [present[c] for c in known if c in present]
    if not found:
        raise ValueError(f"no column to update; at least one of {', '.join(known)} is needed")
    return found


def enrich_accounts(
    target: DataFrame, info: DataFrame, known: Sequence[str] = tuple(ENRICHABLE)
) -> DataFrame:
    """Overwrite the known columns that ``target`` has, for the uids found in ``info``."""
    given = {c.lower(): c for c in info.columns}
    columns = [c for c in updatable_columns(target, known) if c.lower() in given]
    renamed = [F.col(given[c.lower()]).alias(c) for c in columns]
    return update_from(target, info.select("uid", *renamed), ["uid"], columns)


def resolve_uid_by_name(target: DataFrame, accounts: DataFrame) -> DataFrame:
    """Set ``uid`` from the account of the same name, ignoring case.

    Several accounts whose names differ only in case: the smallest uid wins. Names are reduced to
    those asked for before the accounts are grouped.
    """
    updatable_columns(target, ["uid"])
    names = target.select(F.lower("username").alias("_name")).filter(F.col("_name") != "").distinct()
    named = accounts.select(F.lower("username").alias("_name"), "uid")
    found = look_up(named, names, ["_name"], "left_semi").groupBy("_name").agg(F.min("uid").alias("uid"))
    keyed = target.withColumn("_name", F.lower("username"))
    return update_from(keyed, found, ["_name"], ["uid"]).select(*target.columns)


# --- codes -----------------------------------------------------------------------------------

def quota_check(
    requests: DataFrame, batches: DataFrame, codes: DataFrame, limit: int = MAX_CODES_PER_BATCH
) -> DataFrame:
    """Each request (request_id, batch_id, amount) with existing codes, acceptance and status text.

    A request is refused when its batch is unknown, or when existing and requested codes together
    exceed ``limit``. Codes are counted per batch before the join.
    """
    rows = _with_stock(requests, batches, codes)
    over = F.col("existing") + F.col("amount") > limit
    return _with_status(rows.withColumn("accepted", F.col("_known") & ~over), limit)


def quota_in_order(
    requests: DataFrame,
    batches: DataFrame,
    codes: DataFrame,
    limit: int = MAX_CODES_PER_BATCH,
    order: Sequence[str] = ("request_id",),
) -> DataFrame:
    """:func:`quota_check` for a whole sheet worked off in ``order``: each request also sees the codes
    of the accepted ones before it in its batch.

    The requests are range-partitioned by batch and order once. Rounds of running sums follow: of what is
    undecided in a batch, all before the first that does not fit are accepted, that one is refused,
    and so is whatever is larger than the room now left. A batch of any size is spread over tasks.
    The rounds run when the query is built. Requests without batch or amount are refused.
    """
    rows = _with_stock(requests, batches, codes, order)
    countable = F.coalesce(F.col("_known") & F.col("batch_id").isNotNull(), F.lit(False))
    held = ranged(rows.filter(countable), ["batch_id", *order])
    place = ["batch_id", "_part", "_row"]
    asked = held.filter("amount is not null")
    taken = _accepted(asked.select(*place, "amount", (F.lit(limit) - F.col("existing")).alias("_room")))
    held = look_up(held, taken.withColumn("_taken", F.lit(True)), place)
    held = held.withColumn("accepted", F.coalesce("_taken", F.lit(False)))
    held = held.withColumn("_counts", F.when(F.col("accepted"), F.col("amount")).otherwise(0))
    held = sums_before(held, "batch_id", "_counts", "_before")
    seen = (F.col("existing") + F.col("_before")).cast(rows.schema["existing"].dataType)
    checked = held.withColumn("existing", seen).select(*rows.columns, "accepted")
    others = rows.filter(~countable).withColumn("accepted", F.lit(False))
    return _with_status(checked.unionByName(others), limit)


def _accepted(open_: DataFrame) -> DataFrame:
    """(batch_id, _part, _row) of the requests (with amount and _room) that are accepted in their order."""
    taken = []
    here = F.struct("_part", "_row")
    while True:
        rows = sums_before(open_, "batch_id", "amount", "_before")
        misses = rows.filter(F.col("_before") + F.col("amount") > F.col("_room"))
        rows = look_up(rows, misses.groupBy("batch_id").agg(F.min(here).alias("_first")), ["batch_id"])
        rows = rows.withColumn("_state", F.when(F.col("_first").isNull() | (here < F.col("_first")), 0).when(here > F.col("_first"), 1))
        rows = rows.filter("_state is not null")  # the first that does not fit is refused
        spent = rows.groupBy("batch_id").agg(
            F.sum(F.when(F.col("_state") == 0, F.col("amount")).otherwise(0)).alias("_spent"),
            F.min(F.when(F.col("_state") == 1, F.col("amount"))).alias("_least"),
        )
        rows = look_up(rows, spent, ["batch_id"]).withColumn("_left", F.col("_room") - F.col("_spent"))
        # With a negative amount to come, the room may grow again.
        fits = (F.col("_state") == 0) | (F.col("amount") <= F.col("_left")) | (F.col("_least") < 0)
        rows = stored(rows.filter(fits).select("batch_id", "_part", "_row", "amount", "_left", "_state"), "round")
        taken.append(rows.filter("_state = 0").select("batch_id", "_part", "_row"))
        open_ = rows.filter("_state = 1").select("batch_id", "_part", "_row", "amount", F.col("_left").alias("_room"))
        if open_.isEmpty():
            return reduce(DataFrame.unionByName, taken)


def _with_stock(requests: DataFrame, batches: DataFrame, codes: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Requests with whether their batch is known and how many codes it has."""
    known = batches.select(F.col("id").alias("batch_id")).distinct().withColumn("_known", F.lit(True))
    used = codes.groupBy(F.col("promo_batch_id").alias("batch_id")).agg(F.count("*").alias("_used"))
    rows = look_up(requests, known.join(used, "batch_id", "full_outer"), ["batch_id"])
    rest = [c for c in order if c not in ("request_id", "batch_id", "amount")]
    return rows.select(
        "request_id",
        "batch_id",
        "amount",
        *rest,
        F.coalesce("_used", F.lit(0)).alias("existing"),
        F.coalesce("_known", F.lit(False)).alias("_known"),
    )


def _with_status(rows: DataFrame, limit: int) -> DataFrame:
    """The answer that goes back to whoever asked."""
    existing = F.col("existing").cast("string")
    status = (
        F.when(~F.col("_known"), F.concat(F.lit("[Fail] Invalid Bundle ID "), F.col("batch_id").cast("string")))
        .when(
            ~F.col("accepted"),
            F.concat(
                F.lit("[Fail] There are "), existing,
                F.lit(" Promo Code(s) existing in bundle "), F.col("batch_id").cast("string"),
                F.lit(f". Max {limit:,}"),
            ),
        )
        .otherwise("[Success] Promo Codes in the attachment inserted")
    )
    return rows.select("request_id", "batch_id", "amount", "existing", "accepted", status.alias("status"))


def first_per_batch(requests: DataFrame, order: Sequence[str]) -> DataFrame:
    """The earliest request of each batch by ``order``."""
    rest = [c for c in requests.columns if c != "batch_id" and c not in order]
    first = requests.groupBy("batch_id").agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select("batch_id", "_first.*").select(*requests.columns)


def code_text(seed: str, run: str, batch_id: Column, request_id: Column, n: Column) -> Column:
    """16 characters A–Z, 0–9 from a digest of (seed, run, batch, request, running number).

    Each half is the low eight base-36 digits of 60 digest bits. With a secret seed the codes
    cannot be foretold; with a known one a lost task makes the same codes again.
    """
    parts = [F.lit(seed), F.lit(run), batch_id.cast("string"), request_id.cast("string"), n.cast("string")]
    digest = F.sha2(F.concat_ws("/", *parts), 256)

    def half(start: int) -> Column:
        digits = F.conv(F.substring(digest, start, 15), 16, 36)
        return F.right(F.lpad(digits, 12, "0"), F.lit(CODE_LENGTH // 2))

    return F.concat(half(1), half(16))


def generate_codes(requests: DataFrame, existing: DataFrame, seed: str, run: str = "") -> DataFrame:
    """Exactly ``amount`` new codes per request (request_id, batch_id, amount): distinct, none existing.

    Codes that collide with a stored code or with each other are replaced in further rounds by those
    of the next numbers, until none is missing. Each round is written to the shared folder.
    """
    stock = existing.select(F.col("id").alias("code"))
    lacking = requests.select("request_id", "batch_id", F.col("amount").cast("bigint").alias("lack"), F.lit(1).cast("bigint").alias("next"))
    made = None
    while True:
        # A request becomes blocks of numbers first, so that a large one is made by many tasks.
        blocks = lacking.filter("lack > 0").select(
            "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("lack") - 1) / CODES_PER_BLOCK))).alias("_block")
        ).repartition(requests.sparkSession.sparkContext.defaultParallelism, "request_id", "_block")
        start = F.col("next") + F.col("_block") * CODES_PER_BLOCK
        stop = F.least(start + CODES_PER_BLOCK, F.col("next") + F.col("lack")) - 1
        numbered = blocks.select("request_id", "batch_id", F.explode(F.sequence(start, stop)).alias("n"))
        numbered = numbered.withColumn("code", code_text(seed, run, F.col("batch_id"), F.col("request_id"), F.col("n")))
        first = numbered.groupBy("code").agg(F.min(F.struct("request_id", "n", "batch_id")).alias("r"))
        fresh = first.select("code", "r.*").join(stock, "code", "left_anti")
        if made is not None:
            fresh = fresh.join(made.select("code"), "code", "left_anti")
        fresh = stored(fresh.select("request_id", "batch_id", "code"), "codes")
        made = fresh if made is None else made.unionByName(fresh)
        got = fresh.groupBy("request_id", "batch_id").agg(F.count("*").alias("_got"))
        on = F.col("request_id").eqNullSafe(F.col("_r")) & F.col("batch_id").eqNullSafe(F.col("_b"))
        left = lacking.join(got.withColumnsRenamed({"request_id": "_r", "batch_id": "_b"}), on, "left")
        lack = F.col("lack") - F.coalesce("_got", F.lit(0))
        lacking = stored(
            left.select("request_id", "batch_id", lack.alias("lack"), (F.col("next") + F.col("lack")).alias("next")), "codes-lacking"
        )
        if lacking.filter("lack > 0").isEmpty():
            return made


def code_rows(codes: DataFrame, as_of: str) -> DataFrame:
    """Codes as rows of the code table, active and without an account; append them."""
    now = F.lit(as_of).cast("timestamp")
    return codes.select(
        F.col("code").alias("id"),
        F.col("batch_id").alias("promo_batch_id"),
        now.alias("created"),
        now.alias("modified"),
        F.lit(None).cast("bigint").alias("account_id"),
        F.lit(1).alias("active"),
    )


# --- request sheets and retention ------------------------------------------------------------

def pending_requests(sheet: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sheet rows not in the ledger of processed ones, each once; blank rows drop out.

    Rows are compared as a whole and exactly, NULLs as equal.
    """
    names = sheet.columns
    filled = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in names])
    rows = sheet.filter(filled).distinct()
    done = ledger.select(*[F.col(c).alias(f"_d_{c}") for c in names])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_d_{c}")) for c in names])
    return rows.join(done, same, "left_anti")


def retained(rows: DataFrame, time: str, as_of: str, days: int) -> DataFrame:
    """Rows not older than ``days``; on a table partitioned by date this prunes partitions."""
    return rows.filter(F.col(time) >= time_literal(rows, time, midnight(as_of, -days)))


def retention_plan(rows: DataFrame, time: str, as_of: str, days: int) -> DataFrame:
    """What :func:`retained` would drop: rows per day."""
    old = rows.filter(F.col(time) < time_literal(rows, time, midnight(as_of, -days)))
    day = F.date_format(time, "yyyy-MM-dd").alias("day")
    return old.groupBy(day).agg(F.count("*").alias("row_count"))
