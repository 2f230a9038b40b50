"""Whole runs: embed, block, judge, choose, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samesense.functions.text import group_key
from samesense.operators import blocks as B
from samesense.operators import embed as E
from samesense.operators import prompts as P
from samesense.operators import rows as R
from samesense.operators import survivors as S
from samesense.operators import verdicts as V
from samesense.operators.model import Generate, answered, infer, reply_archive
from samesense.operators.report import run_summary
from samesense.operators.similar import similar_groups
from samesense.skew import lookup, positions
from samesense.sources import tables as T
from samesense.storage import store, temporary

THRESHOLD = 0.8
VERDICTS = ("is_duplicate", "duplicate_group_id", "should_remove", "keep", "cluster_id")


@dataclass
class Run:
    """``result``: the rows with verdicts; ``blocks``: clusters; ``summary``: one row.

    A run with models also hands out what they said: ``replies`` and ``choices`` (prompt,
    context, response, error), the verdict ``records`` per reply, and the ``best`` name per
    member of each group.
    """

    result: DataFrame
    blocks: B.Blocks
    summary: DataFrame
    replies: DataFrame | None = None
    choices: DataFrame | None = None
    records: DataFrame | None = None
    best: DataFrame | None = None

    def metrics(self, euclidean: bool = True) -> DataFrame:
        """Clusters, inertia, and the silhouette on distances and on squared ones.

        The Euclidean figure compares all rows with all rows, the squared one is linear.
        With ``euclidean=False`` the first is null, at any size.
        """
        rows, k = self.blocks.rows, self.blocks.n_clusters
        score = rows.sparkSession.range(1).select(F.lit(None).cast("double").alias("silhouette_score"))
        squared = None
        if k > 1 and self.blocks.n_rows > k:
            squared = B.silhouette_squared(rows, "embedding")
            if euclidean:
                score = B.silhouette(rows, "embedding")
        return score.select(
            F.lit(k).cast("bigint").alias("n_clusters"),
            "silhouette_score",
            F.lit(squared).cast("double").alias("silhouette_squared"),
            F.lit(self.blocks.inertia).cast("double").alias("inertia"),
        )


@dataclass
class Judged:
    """Rows with verdicts, and what the models said on the way."""

    rows: DataFrame
    replies: DataFrame | None = None
    choices: DataFrame | None = None
    best: DataFrame | None = None


def _choose(
    members: DataFrame,
    rows: DataFrame,
    survivor: Generate | None,
    incremental: bool,
    page_rows: int,
    folder: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Best name per group; a group with an existing row never reaches the model."""
    old = replies = None
    if incremental:
        old = S.existing_best(members, rows)
        known = old.select("group_id", F.lit(True).alias("_old"))
        members = lookup(members, known, ["group_id"], ["attribute_name"])
        members = members.where("_old is null").drop("_old")
    if survivor is None:
        best = S.rule_best(members, rows)
    else:
        best, replies = S.model_choices(members, rows, survivor, incremental, page_rows, folder)
    return best if old is None else old.unionByName(best), replies


def number_groups(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """Name groups ``cluster_c_group1, cluster_c_group2, ...`` by their first row."""
    heads = groups.where("row_id = root").join(rows.select("row_id", "cluster_id"), "row_id")
    numbered = positions(heads.select("root", "cluster_id"), "root", ["cluster_id"], "number")
    named = numbered.select(
        "root",
        group_key(
            F.col("cluster_id"), F.concat(F.lit("group"), F.col("number").cast("string"))
        ).alias("group_id"),
    )
    return lookup(groups, named, ["root"], ["row_id"], "inner").select("row_id", "group_id")


def _by_similarity(
    rows: DataFrame,
    vector: str,
    threshold: float,
    survivor: Generate | None,
    incremental: bool,
    drop_same_name: bool,
    page_rows: int,
    folder: str | None,
) -> Judged:
    """Verdicts by row: rows of a block connected by similar vectors are one group."""
    groups = store(similar_groups(rows, "cluster_id", vector, threshold), "connected")
    plain = rows.drop(vector)
    named = store(number_groups(groups, plain), "groups")
    grouped = plain.join(named, "row_id")
    choices = None
    if survivor is None:
        age, seen = S.age_of(grouped) if incremental else (F.lit(1), F.lit(0.0))
        is_old = age == 0
        rule = S.rule_rank(grouped)
        rank = F.struct(
            age.alias("age"),
            F.when(is_old, seen).alias("seen"),
            F.when(~is_old, rule).alias("rule"),
            "row_id",
        )
        best = grouped.groupBy("group_id").agg(
            F.min_by(F.struct("attribute_name", "row_id"), rank).alias("_b")
        ).select(
            "group_id",
            F.col("_b.attribute_name").alias("_best"),
            F.col("_b.row_id").alias("_stays"),
        )
    else:
        members = grouped.select("group_id", "attribute_name", F.col("row_id").alias("seq"))
        names, choices = _choose(members, grouped, survivor, incremental, page_rows, folder)
        stays = lookup(grouped, names, ["group_id"], ["row_id"], "inner").where(
            "attribute_name <=> best_attribute"
        )
        best = stays.groupBy("group_id").agg(
            F.first("attribute_name").alias("_best"), F.min("row_id").alias("_stays")
        )
    judged = lookup(
        grouped.select("row_id", "group_id", "attribute_name"), best, ["group_id"], ["row_id"]
    )
    stays = F.col("row_id") == F.col("_stays")
    if not drop_same_name:
        stays = stays | F.col("attribute_name").eqNullSafe(F.col("_best"))
    verdict = judged.select(
        "row_id", F.col("group_id").alias("duplicate_group_id"), stays.alias("keep")
    )
    done = (
        R.attach(plain, verdict)
        .withColumn("is_duplicate", F.col("duplicate_group_id").isNotNull())
        .withColumn("keep", F.coalesce("keep", F.lit(True)))
    )
    shown = judged.select("group_id", "attribute_name", F.col("_best").alias("best_attribute"))
    return Judged(done, None, choices, shown)


def _by_model(
    rows: DataFrame,
    judge: Generate,
    survivor: Generate | None,
    incremental: bool,
    drop_same_name: bool,
    page_rows: int,
    folder: str | None,
    vector: str | None,
    candidates: float | None,
    hand_out: bool,
) -> Judged:
    """Verdicts by name: a model reads the listing of each block.

    A prompt that fails to the last attempt is recorded, and its rows count as different. Where replies
    are not handed out, those to very many pages are read where they are given, and only what they say is written.
    """
    listed, many = P.listed_pages(R.in_shared_clusters(rows), page_rows, vector, candidates)
    listed = listed.where("n_rows > 1")
    rows = rows if vector is None else rows.drop(vector)
    if many and not hand_out and folder is None:
        asked = P.detect_prompts(listed).select("cluster_id", "page", "attributes", "prompt")
        linked = store(V.linked_names(infer(asked, judge, on_error="record", in_place=True)), "linked")
        merged = store(V.merge_links(linked, rows), "merged")
        return _from_items(merged, rows, survivor, incremental, drop_same_name, page_rows, folder)
    replies = answered(P.detect_prompts(listed), judge, "replies", folder, on_error="record")
    items = store(V.verdict_items(replies), "items")
    merged = store(V.merge_pages(items, rows), "merged")
    judged = _from_items(merged, rows, survivor, incremental, drop_same_name, page_rows, folder)
    judged.replies = replies
    return judged


def _from_items(
    items: DataFrame,
    rows: DataFrame,
    survivor: Generate | None,
    incremental: bool,
    drop_same_name: bool,
    page_rows: int,
    folder: str | None = None,
) -> Judged:
    flags = store(V.flagged_items(items, rows), "flags")
    shared = store(V.shared_groups(V.group_members(flags)), "shared")
    best, choices = _choose(shared, rows, survivor, incremental, page_rows, folder)
    best = store(best, "best")
    judged = V.apply_by_name(rows, V.name_verdicts(flags))
    marked = S.mark_losers(judged, S.losing_names(shared, best))
    if drop_same_name:
        # of the rows that carry a winning name the first one stays
        winners = best.select(F.col("best_attribute").alias("attribute_name")).distinct()
        first = lookup(rows, winners, ["attribute_name"], ["row_id"], "left_semi").groupBy("attribute_name").agg(
            F.min("row_id").alias("_stays")
        )
        marked = lookup(marked, first, ["attribute_name"], ["row_id"]).withColumn(
            "keep", F.col("keep") & (F.col("_stays").isNull() | (F.col("row_id") == F.col("_stays")))
        ).drop("_stays")
    return Judged(marked, None, choices, S.best_records(shared, best))


def verdicts_from_items(
    items: DataFrame,
    rows: DataFrame,
    survivor: Generate | None = None,
    incremental: bool = False,
    page_rows: int = P.PAGE_ROWS,
    drop_same_name: bool = False,
) -> DataFrame:
    """Apply verdict items to the rows by name and choose the survivors."""
    return _from_items(items, rows, survivor, incremental, drop_same_name, page_rows).rows


def judge_rows(
    clustered: DataFrame,
    judge: Generate | None = None,
    survivor: Generate | None = None,
    *,
    threshold: float = THRESHOLD,
    vector: str = "embedding",
    incremental: bool = False,
    drop_same_name: bool = False,
    page_rows: int = P.PAGE_ROWS,
    replies: str | None = None,
    candidates: float | None = THRESHOLD,
    hand_out: bool = True,
) -> Judged:
    """``detect_duplicates`` with the models' replies and the best names.

    A judge is shown rows of a block larger than a page together from the similarity
    ``candidates`` on, if there are vectors; with None any two rows, at the price of prompts that
    grow with the square of the block.
    With a folder ``replies`` the models' replies are kept there and no prompt is asked twice. Without
    ``hand_out`` the result may come without the replies of the judge.
    """
    rows = clustered.drop("is_duplicate", "duplicate_group_id", "keep", "should_remove")
    if judge is None:
        return _by_similarity(
            rows, vector, threshold, survivor, incremental, drop_same_name, page_rows, replies
        )
    shown = vector if vector in rows.columns else None
    return _by_model(rows, judge, survivor, incremental, drop_same_name, page_rows, replies, shown, candidates, hand_out)


def detect_duplicates(
    clustered: DataFrame,
    judge: Generate | None = None,
    survivor: Generate | None = None,
    **options,
) -> DataFrame:
    """Judge rows that carry ``cluster_id``: adds ``is_duplicate, duplicate_group_id, keep``.

    Without ``judge`` rows are compared by the cosine of ``vector``; with it, the model's
    replies are parsed and applied by name. Without ``survivor`` a rule picks who stays.
    Options are those of ``judge_rows``.
    """
    return judge_rows(clustered, judge, survivor, **{"hand_out": False, **options}).rows


def deduplicate(
    df: DataFrame,
    make_encoder: Callable[[], E.Encoder] | None = None,
    judge: Generate | None = None,
    survivor: Generate | None = None,
    *,
    max_cluster_size: int = B.MAX_CLUSTER_SIZE,
    max_clusters: int = B.MAX_CLUSTERS,
    seed: int = B.SEED,
    starts: int = B.STARTS,
    threshold: float = THRESHOLD,
    incremental: bool = False,
    drop_same_name: bool = False,
    page_rows: int = P.PAGE_ROWS,
    partitions: int | None = None,
    vectors: DataFrame | None = None,
    centers: DataFrame | None = None,
    replies: str | None = None,
    candidates: float | None = THRESHOLD,
) -> Run:
    """Find duplicates in ``row_id, attribute_name, attribute_definition`` rows.

    ``partitions`` deals the rows out before they are embedded, for tables that are
    small in bytes but much work for the encoder. Rows whose ``row_id`` is in ``vectors``
    (``row_id, embedding``, as an earlier run wrote them) are not embedded again.
    With ``centers`` (``cluster_id, center``) each row goes to the nearest of them, and no
    k-means is fitted. ``replies`` names a folder that keeps the models' replies: a run that was
    stopped, or one over more rows, asks only prompts that have no reply there. ``candidates`` is
    the similarity from which two rows of a block larger than a page share a prompt (see ``judge_rows``).
    """
    if incremental and "source" not in df.columns:
        raise ValueError("an incremental run needs earlier results; see deduplicate_incremental")
    # what a run needs on its way is deleted at its end; what it hands out is kept
    with temporary() as keep:
        rows = df.drop(*VERDICTS)
        if "source" not in rows.columns:
            rows = R.tag(rows, R.NEW, R.FIRST_ROUND)
        text = E.with_text(rows if partitions is None else rows.repartition(partitions))
        encode = E.embed_hashed if make_encoder is None else (lambda df: E.embed(df, make_encoder))
        if vectors is None:
            embedded = encode(text)
        else:
            stored = vectors.select("row_id", F.col("embedding").cast("array<float>").alias("embedding"))
            known = text.join(stored, "row_id").select(*text.columns, "embedding")
            embedded = known.unionByName(
                encode(text.join(stored.select("row_id"), "row_id", "left_anti").select(*text.columns))
            )
        embedded = store(embedded.drop("text"), "embedded")
        if centers is None:
            fitted = B.fit_blocks(embedded, "embedding", max_cluster_size, max_clusters, seed, starts)
        else:
            fitted = B.given_blocks(embedded, "embedding", centers)
        fitted.rows = keep(store(fitted.rows, "clustered"))
        judged = judge_rows(
            fitted.rows,
            judge,
            survivor,
            threshold=threshold,
            incremental=incremental,
            drop_same_name=drop_same_name,
            page_rows=page_rows,
            replies=replies,
            candidates=candidates,
        )
        result = keep(store(R.removal_flag(judged.rows), "result"))
        best = None if judged.best is None else keep(store(judged.best, "best"))
        said = None if judged.replies is None else keep(judged.replies)
        choices = None if judged.choices is None else keep(store(judged.choices, "all-choices"))
        summary, records = run_summary(result), None
        if said is not None:
            records = V.verdict_records(said)
            failed = said.agg(F.count_if(F.col("error").isNotNull())).scalar()
            summary = summary.withColumn("failed_prompts", failed)
        return Run(result, fitted, summary, said, choices, records, best)


def write_all(
    run: Run,
    folder: str,
    run_id: str,
    input_file: str,
    *,
    incremental: bool = False,
    previous_results: str | None = None,
    config: dict[str, str] | None = None,
    seconds: float = 0.0,
    euclidean: bool = True,
) -> None:
    """Write everything a run leaves behind under ``folder``."""
    blocks = run.blocks
    T.write_embeddings(blocks.rows, f"{folder}/embeddings")
    sizes = B.cluster_sizes(blocks.rows, blocks.n_clusters)
    T.write_blocks(blocks.rows.drop("embedding"), sizes, run.metrics(euclidean), folder)
    if run.records is not None:
        records = run.records.select("cluster_id", "page", "attributes", "duplicates", "duplicate_groups")
        T.write_verdicts(records, run.best, folder)
    for name, said in (("detect_replies", run.replies), ("best_replies", run.choices)):
        if said is not None:
            T.write_parquet(reply_archive(said), f"{folder}/{name}")
    T.write_run(run.result, run_id, folder)
    metadata = T.run_metadata(
        run.summary, run_id, input_file, incremental, previous_results, config or {}, seconds
    )
    T.write_metadata(metadata, folder)


def prepare_previous(result: DataFrame, layout: str = "latest") -> DataFrame:
    """Survivors of an earlier result, without its verdicts.

    ``layout`` says which mark to trust: ``should_remove`` of a latest table, or ``keep``
    of a table from a run folder, whose ``should_remove`` is not filled in.
    """
    if layout == "latest":
        kept = R.survivors_of(result)
    elif layout == "run":
        kept = result.where(F.col("keep"))
    else:
        raise ValueError("layout must be 'latest' or 'run'")
    return R.tag(kept.drop(*VERDICTS), R.EXISTING, R.FIRST_ROUND)


def deduplicate_incremental(
    previous: DataFrame,
    new: DataFrame,
    *args,
    layout: str = "latest",
    round_number: int = R.SECOND_ROUND,
    **options,
) -> Run:
    """Add a batch to the survivors of an earlier run and judge the union."""
    old = prepare_previous(previous, layout)
    fresh = R.tag(new, R.NEW, round_number)
    return deduplicate(R.combine(old, fresh), *args, incremental=True, **options)
