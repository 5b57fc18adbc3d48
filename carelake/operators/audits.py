"""Integrity audits: foreign keys, denied-only references, duplicate keys.

Skew: the foreign-key and duplicate-key audits count per key value with a
partial aggregation inside each task before their one shuffle, so a key that
holds a third of all references costs one row per task in the shuffle, not
a third of the table.  NULL references are dropped first: they are not
references, and they would all hash to one partition.  The denied-reference
audit joins on the cited key; a hot key there is split by AQE's skew-join
handling.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (child table, child column, parent table, parent key)
FOREIGN_KEYS = [
    ("eligibility", "member_id", "members", "member_id"),
    ("prior_authorizations", "member_id", "members", "member_id"),
    ("prior_authorizations", "provider_id", "providers", "provider_id"),
    ("claims", "member_id", "members", "member_id"),
    ("claims", "provider_id", "providers", "provider_id"),
    ("claims", "prior_auth_id", "prior_authorizations", "prior_auth_id"),
    ("appeals", "member_id", "members", "member_id"),
    ("appeals", "provider_id", "providers", "provider_id"),
    ("appeals", "prior_auth_id", "prior_authorizations", "prior_auth_id"),
    ("appeals", "claim_id", "claims", "claim_id"),
]

PRIMARY_KEYS = {
    "members": "member_id", "providers": "provider_id", "eligibility": "eligibility_id",
    "prior_authorizations": "prior_auth_id", "claims": "claim_id", "appeals": "appeal_id",
}


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str) -> DataFrame:
    """One row ``(fk, references, orphans)`` for one foreign key."""
    refs = (child.where(F.col(fk).isNotNull())
            .groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("_n")))
    keys = parent.select(F.col(pk).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return (refs.join(keys, "_k", "left")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("references"),
                 F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0))
                  .cast("bigint").alias("orphans"))
            .select(F.lit(name).alias("fk"), "references", "orphans"))


def fk_audit(tables: dict[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """``(fk, references, orphans)`` for every foreign key, in one shuffle.

    Each table is scanned once: its foreign-key values and (when it is a
    parent) its own key become ``(fk, parent, key, n)`` rows through one
    ``explode`` of a fixed-length array, counted per key inside each task.
    One ``groupBy(parent, key)`` then sees, for each key, the reference
    counts of every foreign key and whether the parent row exists; a second,
    tiny aggregate sums per foreign key.  No join and no re-scan per foreign
    key; a key holding a third of all references is collapsed map-side
    before the shuffle."""
    names = [f"{c}.{fk}" for c, fk, _, _ in fks]
    parent_keys = dict(sorted({(p, pk) for _, _, p, pk in fks}))
    emitted: dict[str, list] = {}
    for c, fk, p, pk in fks:
        emitted.setdefault(c, []).append(F.struct(F.lit(f"{c}.{fk}").alias("fk"), F.lit(p).alias("parent"),
                                                  F.col(fk).alias("key"), F.lit(1).cast("bigint").alias("n")))
    for p, pk in parent_keys.items():
        emitted.setdefault(p, []).append(F.struct(F.lit(None).cast("string").alias("fk"), F.lit(p).alias("parent"),
                                                  F.col(pk).alias("key"), F.lit(0).cast("bigint").alias("n")))
    u = None
    for table, structs in emitted.items():
        part = (tables[table].select(F.explode(F.array(*structs)).alias("_r"))
                .select("_r.fk", "_r.parent", "_r.key", "_r.n")
                .where(F.col("key").isNotNull()))
        u = part if u is None else u.unionByName(part)
    per_key = u.groupBy("parent", "key").agg(
        F.max(F.col("fk").isNull()).alias("has_parent"),
        *[F.sum(F.when(F.col("fk") == n, F.col("n"))).alias(f"_c{i}") for i, n in enumerate(names)])
    totals = per_key.agg(*[
        x for i in range(len(names)) for x in (
            F.coalesce(F.sum(f"_c{i}"), F.lit(0)).cast("bigint").alias(f"_r{i}"),
            F.coalesce(F.sum(F.when(~F.col("has_parent"), F.col(f"_c{i}"))), F.lit(0)).cast("bigint")
             .alias(f"_o{i}"))])
    rows = F.array(*[F.struct(F.lit(n).alias("fk"), F.col(f"_r{i}").alias("references"),
                              F.col(f"_o{i}").alias("orphans")) for i, n in enumerate(names)])
    return totals.select(F.explode(rows).alias("_x")).select("_x.fk", "_x.references", "_x.orphans")


def fk_audit_by_join(tables: dict[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """Same result, one anti-style join per foreign key (reference form)."""
    out = None
    for child, fk, parent, pk in fks:
        part = fk_orphans(tables[child], fk, tables[parent], pk, f"{child}.{fk}")
        out = part if out is None else out.unionByName(part)
    return out


def key_bits(key: Column) -> dict[str, Column]:
    """``key`` as a bit of a bitmap: shape (number of last digits and the text
    before them), word (the number's 64-bit word) and bit (one bit set).  Equal
    exactly where the keys are equal; a key without last digits, or with more
    than 18, is its own shape."""
    key = key.cast("string")
    head = F.rtrim(key, F.lit("0123456789"))
    size = F.char_length(key) - F.char_length(head)
    numeric = size.between(1, 18)
    number = F.coalesce(F.when(numeric, F.right(key, size)).try_cast("bigint"), F.lit(0).cast("bigint"))
    return {"shape": F.when(numeric, F.concat(size.cast("string"), F.lit(":"), head)).otherwise(F.concat(F.lit("0:"), key)),
            "word": F.shiftright(number, 6),
            "bit": F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))}


def fk_audit_bitmaps(tables: dict[str, DataFrame], fks=FOREIGN_KEYS) -> DataFrame:
    """``fk_audit`` with the keys shuffled as exact bitmaps.

    Keys are bits of 64-bit words (``key_bits``), which ``bit_or`` builds inside
    each task, for parents and for every foreign key alike, so up to 64 keys are
    one row of the shuffle, and scattered keys never more rows than keys.  Each
    column is read for itself, so a task's loop is one key and two aggregates.
    The words are written once to the checkpoint folder.  A word in which no
    cited key has a parent gives its references as orphans, a word in which all
    have one gives none.  Only foreign keys with words of both are read again
    and counted by key."""
    names = [f"{c}.{fk}" for c, fk, _, _ in fks]
    cited = {f"{c}.{fk}": (c, fk, f"{p}.{pk}") for c, fk, p, pk in fks}

    def bits(table: str, key: str, fk: str | None, parent: str) -> DataFrame:
        return tables[table].select(F.lit(fk).cast("string").alias("fk"), F.lit(parent).alias("parent"),
                                    *(c.alias(n) for n, c in key_bits(F.col(key)).items()))

    rows = None
    for part in [*(bits(c, fk, n, p) for n, (c, fk, p) in cited.items()),
                 *(bits(p, pk, None, f"{p}.{pk}") for p, pk in sorted({(p, pk) for _, _, p, pk in fks}))]:
        rows = part if rows is None else rows.unionByName(part)
    words = (rows.groupBy("fk", "parent", "shape", "word").agg(F.bit_or("bit").alias("bits"), F.count(F.lit(1)).alias("n"))
             .checkpoint(eager=True).where(F.col("shape").isNotNull()))  # null keys are no references
    own = words.where(F.col("fk").isNull()).select("parent", "shape", "word", F.col("bits").alias("has"))
    per_fk = words.where(F.col("fk").isNotNull()).join(own, ["parent", "shape", "word"], "left").withColumn(
        "missing", F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("has", F.lit(0).cast("bigint")))))
    none = F.col("bits") == F.col("missing")
    counts = per_fk.groupBy("fk").agg(F.sum("n").alias("references"),
                                      F.sum(F.when(none, F.col("n")).otherwise(0)).alias("orphans"))
    mixed = per_fk.where(~none & (F.col("missing") != 0)).select("fk", "shape", "word", "missing")
    for n in sorted(r.fk for r in mixed.select("fk").distinct().collect()):
        again = bits(cited[n][0], cited[n][1], n, cited[n][2]).groupBy("fk", "shape", "word", "bit").agg(F.count(F.lit(1)).alias("n"))
        hit = again.join(mixed.where(F.col("fk") == n), ["fk", "shape", "word"]).where(F.col("bit").bitwiseAND(F.col("missing")) != 0)
        counts = counts.unionByName(hit.select("fk", F.lit(0).cast("bigint").alias("references"), F.col("n").alias("orphans")))
    zero = tables[fks[0][0]].sparkSession.createDataFrame([(n, 0, 0) for n in names], "fk string, references long, orphans long")
    return (counts.unionByName(zero).groupBy("fk")
            .agg(F.sum("references").alias("references"), F.sum("orphans").alias("orphans")))


def denied_reference_audit(appeals: DataFrame, claims: DataFrame, pas: DataFrame) -> DataFrame:
    """Appeals citing a claim that is not denied or a PA that was approved
    (or a parent that does not exist): ``(appeal_id, ref_type, ref_id, ref_state)``.

    One left join per reference type: the non-null references against the
    parents' states, violations kept after it.  Nothing runs while the plan is
    built; AQE broadcasts a small side by its measured bytes and splits a key
    that is cited very often.  References without any parent are reported as
    ``missing``."""
    def check(refs: DataFrame, state: DataFrame) -> DataFrame:
        found = refs.join(state, "ref_id", "left")
        return found.where(F.col("ref_state").isNull() | (F.col("ref_state") != "Denied"))

    refs_c = (appeals.where(F.col("claim_id").isNotNull())
              .select("appeal_id", F.lit("claim").alias("ref_type"), F.col("claim_id").alias("ref_id")))
    refs_p = (appeals.where(F.col("prior_auth_id").isNotNull())
              .select("appeal_id", F.lit("prior_auth").alias("ref_type"), F.col("prior_auth_id").alias("ref_id")))
    state_c = claims.select(F.col("claim_id").alias("ref_id"), F.col("status").alias("ref_state"))
    state_p = pas.select(F.col("prior_auth_id").alias("ref_id"),
                         F.when(F.col("is_approved"), F.lit("Approved")).otherwise(F.lit("Denied"))
                          .alias("ref_state"))
    both = check(refs_c, state_c).unionByName(check(refs_p, state_p))
    return both.select("appeal_id", "ref_type", "ref_id",
                       F.coalesce(F.col("ref_state"), F.lit("missing")).alias("ref_state"))


def duplicate_key_audit(tables: dict[str, DataFrame], pks=PRIMARY_KEYS) -> DataFrame:
    """Per table: rows, distinct keys, keys that occur more than once, NULL keys.

    All tables' keys go through one ``groupBy(table, key)`` (partial counts
    per task before the shuffle), then a small per-table aggregate."""
    u = None
    for name, pk in pks.items():
        part = tables[name].select(F.lit(name).alias("table_name"), F.col(pk).cast("string").alias("_k"))
        u = part if u is None else u.unionByName(part)
    per_key = u.groupBy("table_name", "_k").agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy("table_name").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count("_k").alias("distinct_keys"),
        F.count(F.when(F.col("_k").isNotNull() & (F.col("_n") > 1), F.lit(1))).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).cast("bigint").alias("null_keys"))
