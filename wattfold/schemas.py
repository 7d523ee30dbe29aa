"""Column layouts of the operational tables, the star schema and the readings."""

from __future__ import annotations

READING = "meter_id BIGINT, measure DOUBLE, datetime_measured TIMESTAMP_NTZ"

METER_LIST = "meter_id BIGINT, contract_id BIGINT"

# One row of the speed-layer table; ``raw`` keeps the text of lines that did not parse.
SPEED_READING = READING + ", raw STRING, run STRING, batch_id BIGINT, valid BOOLEAN"

READING_COLUMNS = ("meter_id", "measure", "datetime_measured")

BRIDGE_COLUMNS = ("customer_id", "contract_id", "meter_id")

CONSUMPTION_FACT = ("date_id", "customer_id", "contract_id", "meter_id", "time_of_day", "consumption")

REVENUE_FACT = ("date_id", "customer_id", "contract_id", "meter_id", "revenue")
