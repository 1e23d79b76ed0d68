"""Synthetic entity values: 40 subtypes, each a weighted list of formats.

A format is a sequence of literals, integers in a range and choices. Formats are data:
they form a small fixed table that is joined to the rows by subtype, and one expression
expands any of them, so there is no 40-way branch and no UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate
from math import lcm

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilcorpus.functions.frames import small_table
from veilcorpus.functions.hashing import draw
from veilcorpus.functions.text import let


@dataclass(frozen=True)
class Num:
    """A random integer `low..high`, times `scale`, as decimal or hexadecimal text."""

    low: int
    high: int
    pad: int = 0
    scale: int = 1
    commas: bool = False
    base: str = "d"  # d, x (lower-case hex) or X (upper-case hex)


@dataclass(frozen=True)
class Pick:
    """One of several texts."""

    texts: tuple[str, ...]


def pick(*texts: str) -> Pick:
    return Pick(texts)


@dataclass(frozen=True)
class Format:
    weight: int
    parts: tuple


def _either(*choices) -> list[Format]:
    """Equally likely choices; a choice is a tuple of parts or a list of formats."""
    groups = [[Format(1, c)] if isinstance(c, tuple) else c for c in choices]
    totals = [sum(f.weight for f in g) for g in groups]
    common = lcm(*totals)
    return [Format(f.weight * (common // t), f.parts) for g, t in zip(groups, totals) for f in g]


def _around(before: tuple, formats: list[Format], after: tuple = ()) -> list[Format]:
    return [Format(f.weight, before + f.parts + after) for f in formats]


# --- Fixed values: the formats ------------------------------------------------

BYTE, HOST_BYTE = Num(0, 255), Num(1, 254)
HEX = Num(0, 0xFFFF, base="x")
DATE = ("2026", Num(1, 12, pad=2), Num(1, 28, pad=2))
SERIAL3, SERIAL4, SERIAL5 = Num(1, 999, pad=3), Num(1, 9999, pad=4), Num(1, 99999, pad=5)
SHORT4 = Num(1, 99, pad=4)
FIVE_DIGITS = Num(10000, 99999)

PRIVATE_IPV4 = _either(
    ("192.168.", BYTE, ".", HOST_BYTE),
    ("10.", BYTE, ".", BYTE, ".", HOST_BYTE),
    ("172.", Num(16, 31), ".", BYTE, ".", HOST_BYTE),
)
INTERNAL_DOMAIN = _either(
    (
        pick("internal-db", "prod-api", "jenkins", "gitlab", "confluence", "grafana", "vault", "registry"),
        pick(".local", ".intranet", ".internal", ".corp.example.com", ".intranet.example.co.jp"),
    )
)


def _mac(separator: str, base: str) -> tuple:
    octet = Num(0, 255, pad=2, base=base)
    return (octet,) + (separator, octet) * 5


MAN_YEN = _either((Num(100, 9999, commas=True), "万円"))
OKU_YEN = [
    Format(1, (Num(1, 9), "億円")),
    Format(9999, (Num(1, 9), "億", Num(1, 9999, commas=True), "万円")),
]
YEN = _either(*[("¥", Num(1, 9, scale=10**e, commas=True)) for e in (5, 6, 7, 8)])
EN = _either((Num(1, 99, scale=100_000, commas=True), "円"))

SHARES = pick("共有フォルダ", "backup", "documents", "project", "共有")
SHARE_SERVER = _either((pick("fileserver01"),), (pick("nas.local"),), (pick("fileserver02"),), PRIVATE_IPV4)
URL_TAIL = (
    pick("", "", "", "", ":8080", ":8443", ":3000", ":9000"),
    pick("/admin", "/hr/portal", "/display/DEV", "/d/api-latency", "/dashboard", "/api/internal/health"),
)
PORTS = pick("5432", "6379", "8443", "3306", "27017", "9092", "19876", "50051")
REGISTRY = (
    pick("registry.internal", "docker.corp.example.com", "ghcr.io/example-corp"),
    "/",
    pick("backend/api-server", "ml-pipeline", "internal-tool", "frontend/web"),
    ":",
)

FORMATS: dict[str, dict[str, list[Format]]] = {
    "network_identifier": {
        "local_ip_v4": PRIVATE_IPV4,
        "local_ip_v6": _either(
            ("fe80::", HEX, ":", HEX),
            ("fd00::", HEX, ":", HEX),
            ("fd", Num(0, 255, pad=2, base="x"), "::", HEX, ":", HEX),
        ),
        "subnet_cidr": _either(
            ("192.168.", BYTE, ".0/24"), ("10.0.0.0/8",), ("172.16.", BYTE, ".0/22"), ("10.", BYTE, ".0.0/16")
        ),
        "mac_address": [
            Format(7, _mac(":", "X")),
            Format(7, _mac("-", "X")),
            Format(3, _mac(":", "x")),
            Format(3, _mac("-", "x")),
        ],
        "internal_hostname": _around(
            (
                pick(
                    "dev-server", "fileserver", "db-primary", "ws", "app-node",
                    "web", "cache", "build", "ci", "gitlab-runner",
                ),
            ),
            _either(("-", Num(1, 99, pad=2)), (Num(1, 99, pad=2),), ("-prod",), ("-stg",), ("-dev",)),
        ),
        "internal_domain": INTERNAL_DOMAIN,
        "internal_url": _around(
            (pick("http", "https"), "://"), _either(INTERNAL_DOMAIN, PRIVATE_IPV4), URL_TAIL
        ),
        "network_share_path": _either(
            _around(("\\\\",), SHARE_SERVER, ("\\", SHARES)), _around(("smb://",), SHARE_SERVER, ("/", SHARES))
        ),
        "port_service": _either(("ポート ", PORTS), (":", PORTS), (PORTS, "番ポート"), ("TCP/", PORTS)),
        "vpn_wifi_config": _either(
            (pick("vpn.corp.example.co.jp", "vpn.example-vpn.local", "vpn.internal"),),
            (pick("EXAMPLE-CORP-5G", "CORP-WIFI", "OFFICE-SECURE-5G"),),
            _around((), PRIVATE_IPV4, (":", pick("51820", "1194", "500"))),
            (pick("gw.example-vpn.local", "gw.corp.internal"),),
        ),
    },
    "system_config": {
        "file_path_unix": _either(
            (
                pick(
                    "/var/log/app", "/home/deploy/releases", "/etc/nginx/sites-enabled",
                    "/opt/app/src/services", "/srv/app/config", "/opt/airflow/dags",
                ),
                "/",
                pick(
                    "error.log", "database.yml", "internal-portal.conf", "PaymentService.java",
                    "secrets.yml", "etl_pipeline.py", "app.log", "settings.py",
                ),
            )
        ),
        "file_path_windows": _either(
            (r"C:\inetpub\wwwroot\api\Web.config",),
            (r"C:\Users\Administrator\AppData\Local\Temp\crash.dmp",),
            (r"D:\deploy\app\bin\Release\net8.0\appsettings.json",),
            (r"HKLM\SOFTWARE\ExampleCorp\LicenseKey",),
            (r"C:\Program Files\App\config", Num(1, 9), ".ini"),
        ),
        "db_schema_table": _either(
            (
                pick("schema_production", "hr_db", "analytics", "dw_staging", "sales_db", "core"),
                ".",
                pick("financial_records", "employees", "raw_events", "fact_sales_daily", "orders", "payments", "users"),
            )
        ),
        "db_column": _either(
            (
                pick(
                    "password_hash", "auth_token", "salary_amount", "users.password_hash",
                    "orders.customer_id", "hr_db.employees.salary_amount", "sessions.auth_token",
                ),
            )
        ),
        "error_log_stacktrace": _either(
            (
                "NullPointerException at com.example.internal.UserRepository.findById(UserRepository.java:",
                Num(10, 300),
                ")",
            ),
            ("ERROR in /opt/app/src/services/PaymentService.java:", Num(10, 300)),
            ('File "/opt/airflow/dags/etl_pipeline.py", line ', Num(10, 200), ", in run"),
            ("[FATAL] /srv/app/config/secrets.yml: permission denied",),
        ),
        "env_variable": _either(
            (
                pick(
                    "DATABASE_URL", "SECRET_KEY", "AWS_ACCESS_KEY_ID",
                    "INTERNAL_API_BASE_URL=http://api.internal:8080",
                    "REDIS_URL", "JWT_SECRET", "SENTRY_DSN",
                ),
            )
        ),
        "config_key_value": _either(
            ("max_connections: ", pick("100", "200", "500")),
            ("redis_host: cache.internal, redis_port: 6379",),
            ("[database] host=db-primary.local user=app_user",),
            ("worker_processes: ", Num(2, 8), ", timeout: ", pick("30", "60", "120")),
        ),
        "container_image": _around(
            REGISTRY,
            _either(
                ("v", Num(1, 5), ".", Num(0, 9), ".", Num(0, 9)),
                DATE + ("-abc", Num(100, 999)),
                ("latest",),
            ),
        ),
        "internal_api_endpoint": _either(
            ("http://payment-service.internal:", pick("8080", "8443"), "/v1/charge"),
            ("grpc://user-service.default.svc.cluster.local:50051",),
            _around(("http://",), PRIVATE_IPV4, (":3000/api/internal/health",)),
        ),
        "cron_batch_schedule": _either(
            ("0 2 * * * /opt/scripts/db_backup.sh",),
            ("*/5 * * * * /usr/local/bin/health_check.sh",),
            (Num(0, 59), " ", Num(0, 23), " * * * /home/batch/run_etl.py"),
        ),
    },
    "financial_info": {
        "revenue_sales": _either(OKU_YEN, YEN, MAN_YEN),
        "cost_cogs": _either(MAN_YEN, YEN, (Num(40, 90), "%")),
        "profit_margin": _either((Num(5, 40), ".", Num(0, 9), "%"), (Num(5, 40), "%"), MAN_YEN),
        "budget_forecast": _either(OKU_YEN, MAN_YEN, YEN),
        "contract_amount": _either(EN, ("$", Num(10, 500, scale=1000, commas=True), " USD"), YEN),
        "investment_funding": _either((Num(1, 50), "億円"), ("$", Num(1, 20), "M USD"), OKU_YEN),
        "salary_compensation": _either(
            (Num(25, 120), "万円"), (Num(20, 80, scale=10_000, commas=True), "円"), ("年俸 ", Num(400, 1500), "万円")
        ),
        "freelance_fee": _either(
            (Num(30, 120, scale=10_000, commas=True), "円"),
            ("時間単価 ¥", Num(8, 30, scale=1000, commas=True)),
            (Num(30, 120), "万円"),
        ),
        "penalty_settlement": _either(YEN, MAN_YEN, ("日額 ", Num(1, 50, scale=1000, commas=True), "円")),
        "commission_fee": _either((Num(1, 30), "%"), YEN, ("¥", Num(1, 99, scale=1000, commas=True))),
    },
    "transaction_id": {
        "invoice_number": _either(
            ("INV-",) + DATE + ("-", SERIAL3),
            ("2026-", Num(1, 12, pad=2), "-", SHORT4),
            ("JP-2026-", SERIAL5),
            ("BI-2026-", SERIAL4),
        ),
        "contract_number": _either(
            ("CTR-2026-", SERIAL4), ("BCA-JP-2025-", SHORT4), ("SOW-2026-", SERIAL3), ("MK-2026-", SERIAL4)
        ),
        "purchase_order_number": _either(
            ("PO-", FIVE_DIGITS),
            ("PR-2026-", Num(1, 12, pad=2), "-", SERIAL4),
            ("REQ-2026-", SERIAL4),
            ("PO-",) + DATE + ("-JP-", SHORT4),
        ),
        "quotation_number": _either(
            ("QT-2026-", SERIAL4), ("PROP-2026-", SERIAL4), ("EST-",) + DATE + ("-", SERIAL3), ("JP2026-Q-", SERIAL4)
        ),
        "customer_id": _either(
            ("CUST-", SERIAL5),
            ("TRD-JP-", Num(1, 9999)),
            ("C-",) + DATE + ("-", SERIAL4),
            ("得意先コード ", FIVE_DIGITS),
        ),
        "project_case_code": _either(
            ("PROJ-2026-JP-", Num(1, 999, pad=4)), ("W-2026-", SERIAL4), ("DX-PHASE2",), ("ORD-",) + DATE + ("-", SERIAL4)
        ),
        "approval_number": _either(
            ("RNG-2026-", SERIAL4), ("APR-",) + DATE + ("-", SERIAL4), ("PA-2026-", SERIAL4), ("EXP-2026-", SERIAL4)
        ),
        "shipment_tracking": _either(
            (Num(1000, 9999), "-", Num(1000, 9999), "-", Num(1000, 9999)),
            ("SHP-",) + DATE + ("-", SERIAL4),
            ("JP", Num(10**9, 10**10 - 1), "JP"),
            ("WH-IN-2026-", SERIAL4),
        ),
        "bank_payment_reference": _either(
            ("TRF-",) + DATE + ("-", SERIAL4),
            ("PMT-2026-", SERIAL4),
            ("REF: JP",) + DATE + (SERIAL4,),
            ("AAAABB2L",) + DATE + (Num(100000, 999999),),
        ),
        "support_ticket": _either(
            ("TKT-2026-", SERIAL5),
            ("INC-",) + DATE + ("-", SERIAL4),
            ("SP-2026-JP-", SERIAL4),
            ("#", FIVE_DIGITS),
        ),
    },
}

# --- The table and the expression that expands it -----------------------------

_PART = (
    "STRUCT<texts: ARRAY<STRING>, low: BIGINT, n: BIGINT, scale: BIGINT, pad: INT, commas: BOOLEAN, base: STRING>"
)
FORMAT_TABLE = (
    f"category STRING, subtype STRING, formats ARRAY<STRUCT<upto: BIGINT, parts: ARRAY<{_PART}>>>, total BIGINT"
)


def part_row(part) -> tuple:
    """One part as table data; a literal is a choice of one text."""
    if isinstance(part, Num):
        return (None, part.low, part.high - part.low + 1, part.scale, part.pad, part.commas, part.base)
    texts = list(part.texts) if isinstance(part, Pick) else [part]
    return (texts, 0, len(texts), 1, 0, False, "t")


def format_rows(formats: dict[str, dict[str, list[Format]]] = FORMATS) -> list[tuple]:
    rows = []
    for category, subtypes in formats.items():
        for subtype, alternatives in subtypes.items():
            upto = list(accumulate(f.weight for f in alternatives))
            cells = [(u, [part_row(p) for p in f.parts]) for u, f in zip(upto, alternatives)]
            rows.append((category, subtype, cells, upto[-1]))
    return rows


def format_table(spark: SparkSession) -> DataFrame:
    return small_table(spark, format_rows(), FORMAT_TABLE)


def _part_text(part: Column, index: Column, key: Column, seed: int) -> Column:
    n = draw(seed, "part", key, index) % part.getField("n")
    width = part.getField("pad")

    def digits(number: Column) -> Column:
        return (
            F.when(part.getField("base") == "x", F.lower(F.hex(number)))
            .when(part.getField("base") == "X", F.hex(number))
            .when(part.getField("commas"), F.format_number(number, 0))
            .otherwise(number.cast("string"))
        )

    shown = let((part.getField("low") + n) * part.getField("scale"), digits)
    padded = let(shown, lambda d: F.lpad(d, F.greatest(width, F.length(d)), F.lit("0")))
    text = F.element_at(part.getField("texts"), (n + 1).cast("int"))
    # A choice of one text needs no draw.
    return (
        F.when((part.getField("base") == "t") & (part.getField("n") == 1), F.get(part.getField("texts"), 0))
        .when(part.getField("base") == "t", text)
        .otherwise(padded)
    )


def entity_value(key: Column, formats: Column, total: Column, seed: int) -> Column:
    """One value for `key`, from a row of the format table."""
    chosen = let(
        draw(seed, "format", key) % total,
        lambda ticket: F.element_at(F.filter(formats, lambda f: f.getField("upto") > ticket), 1),
    )
    texts = F.transform(
        chosen.getField("parts"), lambda part, index: _part_text(part, index, key, seed)
    )
    return F.array_join(texts, "")


def add_entities(
    df: DataFrame,
    key: str,
    subtype: str = "subtype_name",
    seed: int = 42,
    pools: Mapping[str, Sequence[str]] | None = None,
    out: str = "entities",
) -> DataFrame:
    """Add one value (probability 0.7) or two distinct ones.

    Where the first ones are equal, up to twice as many values are tried as are wanted, so a subtype with few values may
    give one where two were wanted. `pools` (subtype -> values) replaces the formats of its
    subtypes, and may name new ones; an empty pool leaves the formats in place. Both tables
    hold one row per named subtype; the engine checks their sizes before it broadcasts them. A row whose
    subtype has neither formats nor a pool stays, with null values.
    """
    table = format_table(df.sparkSession).select(F.col("subtype").alias("_s"), "formats", "total")
    joined = df.join(table, F.col(subtype) == F.col("_s"), "left").drop("_s")
    filled = [(s, list(p)) for s, p in (pools or {}).items() if p]
    if filled:
        few = small_table(df.sparkSession, filled, "_s STRING, pool ARRAY<STRING>")
        joined = joined.join(few, F.col(subtype) == F.col("_s"), "left").drop("_s")
    wanted = F.when(draw(seed, "count", F.col(key)) % 10 < 7, F.lit(1)).otherwise(F.lit(2))

    def one_try(i: Column) -> Column:
        try_key = F.concat_ws(":", F.col(key).cast("string"), i.cast("string"))
        value = entity_value(try_key, F.col("formats"), F.col("total"), seed)
        if not filled:
            return value
        at = draw(seed, "pool", try_key) % F.size("pool")
        return F.when(F.col("pool").isNotNull(), F.element_at("pool", (at + 1).cast("int"))).otherwise(value)

    def chosen(n: Column) -> Column:
        def more(first: Column) -> Column:
            tries = F.transform(F.sequence(F.lit(0), n * 2 - 1), one_try)
            return F.when(F.size(F.array_distinct(first)) == n, first).otherwise(F.slice(F.array_distinct(tries), F.lit(1), n))

        return let(F.transform(F.sequence(F.lit(0), n - 1), one_try), more)

    values = let(wanted, chosen)
    scratch = ["formats", "total"] + (["pool"] if filled else [])
    has_values = F.col("formats").isNotNull() | (F.col("pool").isNotNull() if filled else F.lit(False))
    return joined.withColumn(out, F.when(has_values, values)).drop(*scratch)


def known_subtypes(pools: Mapping[str, Sequence[str]] | None = None) -> list[str]:
    """Subtypes that have formats or a filled pool."""
    named = {s for subtypes in FORMATS.values() for s in subtypes}
    return sorted(named | {s for s, p in (pools or {}).items() if p})
