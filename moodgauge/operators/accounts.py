"""Account lists and the one-hop social graph around them."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodgauge.operators.ordering import first_per_key, last_per_key

FIELDS = ["id", "name", "screen_name"]


def members_of(lists: DataFrame, members: DataFrame, camp: str) -> DataFrame:
    """Members of every list of a camp. `lists(list_id, camp)`, `members(list_id, id, ...)`."""
    chosen = lists.filter(F.col("camp") == camp).select("list_id").distinct()
    return members.join(chosen, "list_id", "left_semi")


def list_accounts(members: DataFrame, order) -> DataFrame:
    """The members themselves, the last mention of an account wins."""
    return last_per_key(members, ["id"], order).select(*FIELDS)


def related_accounts(members: DataFrame, edges: DataFrame, order) -> DataFrame:
    """Friends or followers of the members, the first mention of an account wins.

    `edges(src, id, name, screen_name, ...)`. Edges of an account with a very long list are split by
    the adaptive skew join; the aggregate after it combines before its shuffle.
    """
    hops = edges.join(members.select(F.col("id").alias("src")).distinct(), "src", "left_semi")
    return first_per_key(hops.select(*FIELDS, *order), ["id"], order).select(*FIELDS)


def both_ways(friends: DataFrame, followers: DataFrame) -> DataFrame:
    """Followers that are friends too, with the follower's fields."""
    return followers.join(friends.select("id").distinct(), "id", "left_semi")


def any_way(*sides: DataFrame) -> DataFrame:
    """Distinct union of account frames."""
    return reduce(DataFrame.unionByName, sides).dropDuplicates()


def extended_camp(leaders, friends, followers, intersect: bool = True) -> DataFrame:
    """Leaders and the accounts around them."""
    around = both_ways(friends, followers) if intersect else any_way(friends, followers)
    return any_way(around.select(*FIELDS), leaders.select(*FIELDS))


def one_row_per_account(accounts: DataFrame) -> DataFrame:
    """An account that was renamed keeps the smallest (screen_name, name)."""
    return first_per_key(accounts, ["id"], ["screen_name", "name"])


def without(accounts: DataFrame, others: DataFrame) -> DataFrame:
    """Accounts that are not in the other camp."""
    return accounts.join(others.select("id").distinct(), "id", "left_anti")


def tag_camps(bulls: DataFrame, bears: DataFrame) -> DataFrame:
    """Both camps in one frame, bears that are bulls as well left to the bulls."""
    bears = without(bears, bulls)
    return bulls.withColumn("sentiment", F.lit("Bullish")).unionByName(
        bears.withColumn("sentiment", F.lit("Bearish"))
    )
