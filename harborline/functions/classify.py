"""Small classifications as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from harborline.catalog import values as V


def health_class(healthy: Column, latency_ms: Column) -> Column:
    return (F.when(~healthy, "UNHEALTHY")
            .when(latency_ms > V.DEGRADED_LATENCY_MS, "DEGRADED")
            .otherwise("HEALTHY"))


def pull_state(state: Column, merged_at: Column) -> Column:
    return F.when(F.length(merged_at) > 0, "merged").otherwise(state)


def http_error_type(status: Column, body: Column) -> Column:
    """Error name of a failed HTTP answer."""
    text = F.lower(F.coalesce(body, F.lit("")))
    limited = F.contains(text, F.lit("rate limit")) | F.contains(text, F.lit("abuse"))
    return (F.when(status == 401, "ConnectorAuthenticationError")
            .when((status == 403) & limited, "ConnectorRateLimitError")
            .when(status == 403, "ConnectorAuthenticationError")
            .when(status == 404, "ResourceNotFoundError")
            .when(status == 422, "ConnectorFatalError")
            .when(status == 429, "ConnectorRateLimitError")
            .when(status.isin(500, 502, 503, 504), "ConnectorTemporaryError")
            .otherwise("ConnectorNetworkError"))


def retryable(error_type: Column) -> Column:
    return error_type.isin(*V.RETRYABLE_ERRORS)


def is_text(content_type: Column) -> Column:
    return F.startswith(content_type, F.lit("text/"))
