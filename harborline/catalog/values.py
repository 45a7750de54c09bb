"""Fixed values.

Every constant below has to be exactly this for results to agree with the
remote systems and with documents acquired earlier.
"""

from __future__ import annotations

import mimetypes

# Limits.
MAX_DOCUMENT_BYTES = 100 * 1024 * 1024
MAX_OBJECT_BYTES = 50 * 1024 * 1024
MAX_CODE_FILE_BYTES = 1024 * 1024
MAX_ATTACHMENT_BYTES = 5 * 1024 * 1024
MAX_CRAWL_DEPTH = 3
SIGNATURE_WINDOW_S = 300
DEGRADED_LATENCY_MS = 500.0
LOW_QUOTA = 100
BREAKER_FAILURES = 5
LISTING_LIMIT = 100

# Extensions left out by an object scan and by a code scan.
OBJECT_EXCLUDED_EXTENSIONS = (".tmp", ".log", ".lock", ".pyc")
CODE_EXCLUDED_EXTENSIONS = (
    ".png", ".jpg", ".jpeg", ".gif", ".ico", ".svg",
    ".pdf", ".zip", ".tar", ".gz", ".bz2", ".7z",
    ".exe", ".dll", ".so", ".dylib", ".whl",
    ".pyc", ".pyo", ".class",
    ".mp4", ".mp3", ".avi", ".mov", ".wav",
    ".ttf", ".woff", ".woff2", ".eot",
    ".db", ".sqlite",
)

# Extensions known to be text, and those with a type of their own.
TEXT_EXTENSIONS = (
    ".py", ".js", ".ts", ".jsx", ".tsx", ".go", ".rs", ".java",
    ".c", ".cpp", ".h", ".hpp", ".cs", ".rb", ".php", ".swift",
    ".kt", ".scala", ".r", ".m", ".lua", ".pl", ".sh", ".bash",
    ".zsh", ".fish", ".ps1", ".bat", ".cmd",
    ".md", ".mdx", ".rst", ".txt", ".log", ".csv", ".tsv",
    ".json", ".yaml", ".yml", ".toml", ".ini", ".cfg", ".conf",
    ".env", ".xml", ".html", ".htm", ".css", ".scss", ".sass",
    ".sql", ".graphql", ".proto", ".tf", ".hcl",
    ".dockerfile", ".makefile", ".gitignore", ".editorconfig",
)
TEXT_MIME = {
    ".py": "text/x-python",
    ".js": "text/javascript",
    ".ts": "text/typescript",
    ".md": "text/markdown",
    ".json": "application/json",
    ".yaml": "application/yaml",
    ".yml": "application/yaml",
    ".html": "text/html",
    ".css": "text/css",
    ".sql": "text/x-sql",
    ".sh": "text/x-shellscript",
    ".xml": "text/xml",
}
DEFAULT_MIME = "application/octet-stream"


def standard_mime_table() -> dict[str, str]:
    """Extension -> type from the standard library's registry, read on the
    driver once and shipped as a literal, so all executors agree."""
    return dict(mimetypes.MimeTypes().types_map[True])


# Crawl rules.
CRAWL_EXTENSIONS = (
    ".html", ".htm", ".php", ".asp", ".aspx",
    ".pdf", ".md", ".txt", ".rst", ".doc", ".docx",
    ".json", ".xml", ".csv",
)
CRAWL_EXCLUDE_PATTERNS = (
    r"\.(png|jpg|jpeg|gif|ico|svg|webp|mp4|mp3|avi|zip|tar|gz|exe|bin)$",
    r"/(login|logout|signin|signup|register|auth)",
    r"[?&](utm_|fbclid|gclid)",
)
HREF_PATTERN = r"""(?i)href=["']([^"'#]+)["']"""

# Message subtypes that only say somebody came, went or is a bot.
NOISE_SUBTYPES = ("channel_join", "channel_leave", "bot_message")

# Mail labels left out of a request unless asked for.
SPAM_LABELS = ("SPAM", "TRASH")

# Push deliveries a code host may send, and the (type, actions)
# that start an acquisition; None accepts every action.
WEBHOOK_EVENT_TYPES = (
    "push", "issues", "issue_comment", "pull_request", "pull_request_review",
    "pull_request_review_comment", "release", "create", "delete", "repository",
    "star", "fork", "discussion", "discussion_comment", "check_run",
    "workflow_run", "commit_comment", "member", "milestone",
)
WEBHOOK_RULES = {
    "push": None,
    "issues": ("opened", "edited", "closed", "reopened", "created"),
    "issue_comment": ("opened", "edited", "closed", "reopened", "created"),
    "pull_request": ("opened", "edited", "closed", "synchronize", "submitted", "reopened"),
    "pull_request_review":
        ("opened", "edited", "closed", "synchronize", "submitted", "reopened"),
    "release": ("published", "edited", "released"),
    "repository": ("created", "publicized"),
}

# MIME types each kind of source may deliver.
SOURCE_MIME = {
    "confluence": ("text/markdown", "text/plain", "application/json"),
    "github": ("*/*",),
    "gmail": ("application/json", "text/plain", "text/html"),
    "notion": ("text/markdown", "application/json"),
    "postgresql": ("application/json", "text/csv"),
    "rss": ("application/atom+xml", "application/rss+xml", "application/xml", "text/xml"),
    "s3": ("*/*",),
    "slack": ("application/json", "text/plain", "*/*"),
    "web": ("text/html", "text/plain", "application/json", "application/pdf",
            "text/markdown", "*/*"),
}

# Job status moves that are legal.
JOB_MOVES = (
    ("PENDING", "RUNNING"), ("PENDING", "CANCELLED"),
    ("RUNNING", "COMPLETED"), ("RUNNING", "FAILED"), ("RUNNING", "CANCELLED"),
)

# Retry policies (attempts, first wait ms, longest wait ms, growth).
RETRY_POLICIES = {
    "AGGRESSIVE": (5, 200.0, 10_000.0, 1.5),
    "STANDARD": (3, 1_000.0, 60_000.0, 2.0),
    "CONSERVATIVE": (2, 5_000.0, 300_000.0, 3.0),
    "NO_RETRY": (1, 0.0, 0.0, 1.0),
}

# Error names that a retry may cure.
RETRYABLE_ERRORS = (
    "ConnectorNetworkError", "ConnectorRateLimitError", "ConnectorTemporaryError",
    "ConnectorTimeoutError", "TimeoutError", "ConnectionError", "OSError",
)

# The position column's comparison per kind of source.
DELTA_RULES = {
    "s3": (">", "text"), "rss": (">", "double"), "postgresql": (">", "text"),
    "notion": (">", "text"), "slack": (">", "text"), "gmail": (">", "bigint"),
    "confluence": (">=", "text"), "issues": (">=", "text"), "prs": (">=", "text"),
    "commits": (">=", "text"), "releases": (">", "bigint"),
}

# Date forms found in feeds, after any weekday name is removed.
FEED_DATE_FORMATS = (
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss 'GMT'",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
)
