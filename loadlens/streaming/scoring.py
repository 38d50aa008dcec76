"""Scoring a request stream against a static set of files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from loadlens.operators.assets import match_assets
from loadlens.operators.scoring import Scorer, score


def score_stream(
    requests: DataFrame,
    listing: DataFrame,
    scorer: Scorer,
    inputs: Sequence[str] = (),
    carry: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """Stream-static inner join on the normalised path, then the batch scorer. No state is kept."""
    matched = match_assets(requests, listing, salts)
    return score(matched, scorer, inputs, carry)
