"""Row filters of the sources, as predicates (Columns) so that they combine
into one scan filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from harborline.catalog import values as V
from harborline.functions.names import extension


def by_extension(path: Column, deny=(), allow=()) -> Column:
    ext = extension(path)
    keep = ~ext.isin(*deny) if deny else F.lit(True)
    return keep & ext.isin(*allow) if allow else keep


def by_size(size: Column, max_bytes: int, drop_empty: bool = True) -> Column:
    return (size > 0) & (size <= max_bytes) if drop_empty else size <= max_bytes


def issue_not_pull(pull_request: Column) -> Column:
    return pull_request.isNull()


def state_wanted(state: Column, include_closed: bool = True) -> Column:
    return F.lit(True) if include_closed else state == "open"


def pull_wanted(draft: Column, updated_at: Column, include_drafts: bool = False,
                since: str | None = None) -> Column:
    keep = F.lit(True) if include_drafts else ~F.coalesce(draft, F.lit(False))
    return keep & (updated_at >= since) if since else keep


def release_wanted(prerelease: Column, release_id: Column, include_prereleases: bool = True,
                   since_id: int | None = None) -> Column:
    keep = F.lit(True) if include_prereleases else ~F.coalesce(prerelease, F.lit(False))
    return keep & (release_id > since_id) if since_id else keep


def message_wanted(bot_id: Column, subtype: Column, include_bots: bool = False) -> Column:
    if include_bots:
        return F.lit(True)
    from_bot = F.length(F.coalesce(bot_id, F.lit(""))) > 0
    return ~from_bot & ~F.coalesce(subtype.isin(*V.NOISE_SUBTYPES), F.lit(False))


def file_present(mode: Column) -> Column:
    return ~F.coalesce(mode == "tombstone", F.lit(False))


def member_active(deleted: Column, is_bot: Column) -> Column:
    return ~F.coalesce(deleted, F.lit(False)) & ~F.coalesce(is_bot, F.lit(False))


def mail_labelled(labels: Column, wanted, include_spam: bool = False) -> Column:
    """The message carries every wanted label."""
    asked = [w for w in wanted if include_spam or w not in V.SPAM_LABELS]
    if not asked:
        return F.lit(True)
    return F.size(F.array_except(F.array(*map(F.lit, asked)), labels)) == 0


def note_wanted(archived: Column, last_edited: Column, since: str | None = None) -> Column:
    keep = ~F.coalesce(archived, F.lit(False))
    return keep & (last_edited > since) if since else keep


def delivery_acquires(event_type: Column, action: Column) -> Column:
    """Does this push delivery start an acquisition?"""
    hit = F.lit(False)
    for kind, actions in V.WEBHOOK_RULES.items():
        rule = event_type == kind
        hit = hit | (rule if actions is None else rule & action.isin(*actions))
    return F.coalesce(hit, F.lit(False))


def unknown_event_types(events: DataFrame, column: str = "event_type") -> DataFrame:
    """Delivered types outside the supported set, with their counts."""
    return (events.where(~F.col(column).isin(*V.WEBHOOK_EVENT_TYPES))
            .groupBy(column).agg(F.count("*").alias("deliveries")))
