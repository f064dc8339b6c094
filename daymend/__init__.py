"""daymend: build, check and repair date-partitioned fact tables with Spark DataFrames."""

from daymend.plans.flow import ChecksFailed, RunReport, SalesFlow
from daymend.sources.landing import CsvLanding, FrameLanding
from daymend.sources.tables import TableStore

__all__ = ["ChecksFailed", "CsvLanding", "FrameLanding", "RunReport", "SalesFlow", "TableStore"]
