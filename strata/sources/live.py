"""The four live feeds of a full refresh, built from settings."""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as S
from .asking import AskPolicy
from .feeds import LIST_LENGTH
from .transports import HttpTransport

# The request paths of the feeds, below the base address of each service.
DAILY_PATH = "/api/totd/{page_no}"
LEADERBOARD_PATH = "/api/leaderboard/{leaderboard_uid}/{map_uid}?offset=0&length=" + str(LIST_LENGTH)
MAP_INFO_PATH = "/api/maps/get_map_info/uid/{map_uid}"
AUTHORS_PATH = "/api/maps/get_authors/{track_id}"


@dataclass
class Feeds:
    """The transports of X1-X4 and the tag catalogue of X10."""
    daily: object
    map_info: object
    leaderboards: object
    authors: object
    tags: DataFrame
    volume: int = 0                      # bytes that the responses are made from, where that is known


def live_feeds(spark: SparkSession, daily_base: str, maps_base: str, user_agent: str, tags: DataFrame | None = None,
               timeout: float = 30.0, opener: Callable = urllib.request.urlopen,
               policy: AskPolicy = AskPolicy(), sleep: Callable = time.sleep) -> Feeds:
    """``daily_base`` serves the daily pages and leaderboards, ``maps_base`` the
    map info and author lists (addresses without a trailing path).  Every
    request names ``user_agent``; ``policy`` bounds how each feed is asked."""
    def get(base: str, path: str) -> HttpTransport:
        return HttpTransport(base.rstrip("/") + path, {"User-Agent": user_agent}, timeout, opener, policy, sleep)

    return Feeds(daily=get(daily_base, DAILY_PATH), map_info=get(maps_base, MAP_INFO_PATH),
                 leaderboards=get(daily_base, LEADERBOARD_PATH), authors=get(maps_base, AUTHORS_PATH),
                 tags=S.seed_rows(spark) if tags is None else tags)
