"""Registration of named queries."""

from dataclasses import dataclass
from typing import Callable

from quarry.sources.readers import spread


@dataclass(frozen=True)
class Query:
    run: Callable
    sql: str | None


class Catalog:
    def __init__(self):
        self.entries = {}

    def add(self, name, sql=None):
        def keep(fn):
            if name in self.entries:
                raise ValueError(f"query {name} is registered twice")
            self.entries[name] = Query(fn, sql)
            return fn

        return keep


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def heavy(spark, folder, name="documents", key="doc_id"):
    """A table for CPU-heavy row work: spread when its files have few row groups."""
    return spread(table(spark, folder, name), key)


# SQL fragments used by several twins.
TOKENS = r"regexp_extract_all(text, '[A-Za-z0-9_À-ÿ]+|[^A-Za-z0-9_À-ÿ\s]')"
WORDS = r"regexp_extract_all(text, '[A-Za-z0-9_À-ÿ]+')"


def token_count_sql(c="text"):
    return rf"len(regexp_extract_all({c}, '[A-Za-z0-9_À-ÿ]+|[^A-Za-z0-9_À-ÿ\s]'))"


def hash_sql(c):
    return f"(('0x' || substr(md5({c}), 1, 8))::BIGINT % 2147483647)"


def strip_sql(c):
    return rf"regexp_replace({c}, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g')"
