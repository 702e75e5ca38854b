"""The seven product lines and their fifteen rules.

Fixed values: categories, flags, lookbacks, spans and thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from txvigil.plans.rules import BurstRule, Rule, SumRule


@dataclass(frozen=True)
class Family:
    """One product line: which transactions it takes in, and the rules over its history.

    ``n_days`` is the number of daily drops an ingest looks at, ``merge_days`` the lookback of
    a flag merge, None for none. With ``by_position`` the header of a drop is ignored.
    """

    name: str
    categories: tuple[str, ...]
    n_days: int
    rules: tuple[Rule, ...]
    by_position: bool = False
    merge_days: int | None = None
    statuses: tuple[int, ...] = (0,)
    states: tuple[int, ...] = (1,)

    @property
    def flags(self) -> list[str]:
        return [rule.flag for rule in self.rules]


def _minutes(n: int) -> timedelta:
    return timedelta(minutes=n)


_DAY = timedelta(hours=24)

CCW = Family(
    name="ccw",
    categories=("CCW",),
    n_days=2,
    merge_days=2,
    rules=(BurstRule("ccw", "flag", _minutes(10), 3, lookback=2),),
)

TF_ONLINE = Family(
    name="tf_online",
    categories=("TRANSFER_OA", "TRANSFER_OFF_US", "TRANSFER_ON_US"),
    n_days=3,
    rules=(
        BurstRule("tf_online_5min", "flag_5min", _minutes(5), 5, lookback=3),
        BurstRule("tf_online_10min", "flag_10min", _minutes(10), 10, lookback=360),
        SumRule("tf_online_50mio", "flag_50mio", _DAY, 50_000_000, lookback=360),
        SumRule(
            "tf_online_50mio_early", "flag_50mio_early", _DAY, 50_000_000, lookback=360, hours=(0, 6)
        ),
    ),
)

E_WALLET = Family(
    name="e_wallet",
    categories=("PURCHASE_EWALLET",),
    n_days=180,
    rules=(
        BurstRule("ewallet_10min", "flag_10min", _minutes(10), 3, lookback=120),
        SumRule("ewallet_5mio", "flag_5mio", _DAY, 5_000_000, lookback=2),
    ),
)

LISTRIK = Family(
    name="listrik",
    categories=("PURCHASE_PLN_PREPAIDV2",),
    n_days=180,
    by_position=True,
    rules=(
        BurstRule("listrik_10min", "flag_10min", _minutes(10), 3, lookback=2),
        SumRule("listrik_5mio", "flag_5mio", _DAY, 5_000_000, lookback=2),
    ),
)

PULSA = Family(
    name="pulsa",
    categories=("PURCHASE_PHONE", "PURCHASE_PHONE_PREPAID"),
    n_days=120,
    by_position=True,
    rules=(
        BurstRule("pulsa_10min", "flag_10min", _minutes(10), 3, lookback=2),
        SumRule("pulsa_5mio", "flag_5mio", _DAY, 5_000_000, lookback=2),
    ),
)

QR = Family(
    name="qr",
    categories=("QR_TRANSFER", "QR_MPM", "QR_MPM_QUICK_ACCESS"),
    n_days=180,
    by_position=True,
    rules=(
        BurstRule("qr_10min", "flag_10min", _minutes(10), 5),
        SumRule("qr_5mio", "flag_5mio", _DAY, 5_000_000),
    ),
)

NON_QR = Family(
    name="non_qr",
    categories=(
        "PAYMENT_PLN_PASCABAYAR",
        "PAYMENT_KAI",
        "PAYMENT_BPJS_KETENAGAKERJAAN",
        "PAYMENT_TELKOM",
        "PAYMENT_PHONE",
        "PAYMENT_PDAM",
        "PAYMENT_SAMSAT",
        "PAYMENT_TV_INTERNET",
        "PAYMENT_MULTIFINANCE",
    ),
    n_days=180,
    by_position=True,
    rules=(
        BurstRule("non_qr_10min", "flag_10min", _minutes(10), 5),
        SumRule("non_qr_5mio", "flag_5mio", _DAY, 5_000_000),
    ),
)

FAMILIES = {f.name: f for f in (CCW, TF_ONLINE, E_WALLET, LISTRIK, PULSA, QR, NON_QR)}
RULES = {rule.name: rule for family in FAMILIES.values() for rule in family.rules}
ALL_FLAGS = sorted({rule.flag for rule in RULES.values()})
