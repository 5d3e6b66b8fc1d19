"""Connection settings for JDBC sources and the warehouse connector.

Credentials live only in these objects (taken from the caller), never in
tables or logs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: the reference's extraction settings ----------------------
DEFAULT_FETCHSIZE = 10000
DEFAULT_PARTITIONS = 8
WAREHOUSE_FORMAT = "snowflake"
WAREHOUSE_DEFAULT_SCHEMA = "PUBLIC"
# --- end of fixed values -----------------------------------------------------

_DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.OracleDriver",
    "derby": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
}


# Where a database spells a mapped warehouse type differently in DDL
# (public SQL dialect knowledge); unlisted names are used as they are.
_DDL_NAMES = {
    "postgresql": {"TIMESTAMP_TZ": "TIMESTAMPTZ", "FLOAT": "DOUBLE PRECISION"},
    "mysql": {"TIMESTAMP_TZ": "TIMESTAMP", "FLOAT": "DOUBLE"},
    "sqlserver": {"TEXT": "NVARCHAR(MAX)", "BOOLEAN": "BIT", "TIMESTAMP": "DATETIME2",
                  "TIMESTAMP_TZ": "DATETIMEOFFSET"},
    "oracle": {"TEXT": "CLOB", "BOOLEAN": "NUMBER(1)", "BIGINT": "NUMBER(19)",
               "VARCHAR(500)": "VARCHAR2(500)", "TIMESTAMP_TZ": "TIMESTAMP WITH TIME ZONE",
               "FLOAT": "BINARY_DOUBLE"},
    "derby": {"TEXT": "VARCHAR(32672)", "TIMESTAMP_TZ": "TIMESTAMP", "FLOAT": "DOUBLE"},
}


@dataclass(frozen=True)
class Connection:
    """One source or destination. ``url`` overrides the URL built from
    host/port/db_name (used for embedded test databases)."""

    db_type: str
    host: str = ""
    port: int | None = None
    db_name: str = ""
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    schema: str | None = None
    warehouse: str | None = None
    role: str | None = None
    url: str | None = None
    driver: str | None = None
    extra: dict = field(default_factory=dict)

    @property
    def is_warehouse(self) -> bool:
        return self.db_type == WAREHOUSE_FORMAT

    def jdbc_url(self) -> str:
        if self.url:
            return self.url
        t = self.db_type
        if t == "postgresql":
            return f"jdbc:postgresql://{self.host}:{self.port or 5432}/{self.db_name}"
        if t == "mysql":
            return f"jdbc:mysql://{self.host}:{self.port or 3306}/{self.db_name}"
        if t == "sqlserver":
            return f"jdbc:sqlserver://{self.host}:{self.port or 1433};databaseName={self.db_name}"
        if t == "oracle":
            return f"jdbc:oracle:thin:@//{self.host}:{self.port or 1521}/{self.db_name}"
        raise ValueError(f"no JDBC URL for connection type {t!r}")

    def ddl_type(self, warehouse_type: str) -> str:
        """The warehouse type name as this database spells it in DDL."""
        return _DDL_NAMES.get(self.db_type, {}).get(warehouse_type.upper(), warehouse_type)

    def add_column(self, table: str, column: str, warehouse_type: str) -> str:
        """ALTER TABLE statement that adds a column."""
        what = f"{self.quote(column)} {self.ddl_type(warehouse_type)}"
        form = {"sqlserver": "ADD {}", "oracle": "ADD ({})"}.get(self.db_type, "ADD COLUMN {}")
        return f"ALTER TABLE {table} " + form.format(what)

    def change_type(self, table: str, column: str, warehouse_type: str) -> str:
        """ALTER TABLE statement that changes a column's type."""
        c, t = self.quote(column), self.ddl_type(warehouse_type)
        form = {"postgresql": f"ALTER COLUMN {c} TYPE {t} USING {c}::{t}", "mysql": f"MODIFY COLUMN {c} {t}",
                "sqlserver": f"ALTER COLUMN {c} {t}", "oracle": f"MODIFY ({c} {t})"}
        return f"ALTER TABLE {table} " + form.get(self.db_type, f"ALTER COLUMN {c} SET DATA TYPE {t}")

    def quote(self, identifier: str) -> str:
        """Identifier quoted for this database (names keep their case)."""
        if self.db_type == "mysql":
            return "`" + identifier.replace("`", "``") + "`"
        return '"' + identifier.replace('"', '""') + '"'

    def jdbc_options(self, fetchsize: int = DEFAULT_FETCHSIZE) -> dict[str, str]:
        opts = {"url": self.jdbc_url(), "fetchsize": str(fetchsize)}
        drv = self.driver or _DRIVERS.get(self.db_type)
        if drv:
            opts["driver"] = drv
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        # TIMESTAMP columns without a zone are read as timestamp_ntz (those
        # WITH TIME ZONE stay zoned), on every database
        opts["preferTimestampNTZ"] = "true"
        opts.update({k: str(v) for k, v in self.extra.items()})
        return opts

    def warehouse_options(self, database: str, schema: str | None, table: str) -> dict[str, str]:
        """Writer options of the warehouse connector (``format("snowflake")``)."""
        opts = {
            "sfURL": f"{self.host}.snowflakecomputing.com",
            "sfDatabase": database.upper(),
            "sfSchema": (schema or self.schema or WAREHOUSE_DEFAULT_SCHEMA).upper(),
            "dbtable": table.upper(),
        }
        if self.user is not None:
            opts["sfUser"] = self.user
        if self.password is not None:
            opts["sfPassword"] = self.password
        if self.warehouse:
            opts["sfWarehouse"] = self.warehouse
        if self.role:
            opts["sfRole"] = self.role
        return opts
