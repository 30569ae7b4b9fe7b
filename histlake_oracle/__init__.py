"""DuckDB SQL that the library's registered queries are checked against."""

from histlake_oracle.library import ORACLE

__all__ = ["ORACLE"]
