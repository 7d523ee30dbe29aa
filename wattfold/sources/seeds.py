"""Seed tables. Inline relations, so Spark knows their exact size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Price per kWh of each residential slab.
RESIDENTIAL_PRICES = """
    (1, '0-50 kWh', 1806),
    (2, '51-100 kWh', 1866),
    (3, '101-200 kWh', 2167),
    (4, '201-300 kWh', 2729),
    (5, '301-400 kWh', 3050),
    (6, 'More than 401 kWh', 3151)
"""

# Price per kWh by voltage tier and time-of-use band.
COMMERCIAL_PRICES = """
    ('less than 6kV', 'normal', 2870),
    ('less than 6kV', 'low', 1746),
    ('less than 6kV', 'high', 4937),
    ('6kV to less than 22kV', 'normal', 2830),
    ('6kV to less than 22kV', 'low', 1666),
    ('6kV to less than 22kV', 'high', 4736),
    ('22kV and above', 'normal', 2629),
    ('22kV and above', 'low', 1465),
    ('22kV and above', 'high', 4575)
"""

INDUSTRIAL_PRICES = """
    ('less than 6kV', 'normal', 1809),
    ('less than 6kV', 'low', 1184),
    ('less than 6kV', 'high', 3314),
    ('6kV to less than 22kV', 'normal', 1729),
    ('6kV to less than 22kV', 'low', 1124),
    ('6kV to less than 22kV', 'high', 3194),
    ('22kV to less than 100kV', 'normal', 1669),
    ('22kV to less than 100kV', 'low', 1084),
    ('22kV to less than 100kV', 'high', 3093),
    ('100kV and above', 'normal', 1649),
    ('100kV and above', 'low', 1044),
    ('100kV and above', 'high', 2973)
"""

# ISO 3166-2 code, name and coordinates of the provinces of Vietnam.
PROVINCES = """
    ('VN-44', 'An Giang', 10.5216, 105.1259),
    ('VN-43', 'Bà rịa Vũng Tàu', 10.5417, 107.2430),
    ('VN-54', 'Bắc Giang', 21.2820, 106.1975),
    ('VN-53', 'Bắc Kạn', 22.1443, 105.8345),
    ('VN-55', 'Bạc Liêu', 9.2940, 105.7216),
    ('VN-56', 'Bắc Ninh', 21.1782, 106.0710),
    ('VN-50', 'Bến Tre', 10.2434, 106.3756),
    ('VN-31', 'Bình Định', 13.8860, 109.1077),
    ('VN-57', 'Bình Dương', 11.3254, 106.4770),
    ('VN-58', 'Bình Phước', 11.7512, 106.7235),
    ('VN-40', 'Bình Thuận', 11.0904, 108.0721),
    ('VN-59', 'Cà Mau', 9.1527, 105.1961),
    ('VN-CT', 'Cần Thơ', 10.0452, 105.7469),
    ('VN-04', 'Cao Bằng', 22.6666, 106.2640),
    ('VN-DN', 'Đà Nẵng', 16.0544, 108.2022),
    ('VN-33', 'Đắk Lắk', 12.7100, 108.2378),
    ('VN-72', 'Đắk Nông', 12.2646, 107.6098),
    ('VN-71', 'Điện Biên', 21.4064, 103.0322),
    ('VN-39', 'Đồng Nai', 11.0686, 107.1676),
    ('VN-45', 'Đồng Tháp', 10.4938, 105.6882),
    ('VN-30', 'Gia Lai', 13.8079, 108.1094),
    ('VN-03', 'Hà Giang', 22.8026, 104.9784),
    ('VN-63', 'Hà Nam', 20.5835, 105.9230),
    ('VN-HN', 'Hà Nội', 21.0278, 105.8342),
    ('VN-23', 'Hà Tĩnh', 18.3420, 105.8923),
    ('VN-61', 'Hải Dương', 20.9373, 106.3146),
    ('VN-HP', 'Hải Phòng', 20.8449, 106.6881),
    ('VN-73', 'Hậu Giang', 9.7579, 105.6413),
    ('VN-SG', 'TP. Hồ Chí Minh', 10.8231, 106.6297),
    ('VN-14', 'Hòa Bình', 20.8275, 105.3391),
    ('VN-66', 'Hưng Yên', 20.6547, 106.0578),
    ('VN-34', 'Khánh Hòa', 12.2585, 109.0526),
    ('VN-47', 'Kiên Giang', 9.8250, 105.1259),
    ('VN-28', 'Kon Tum', 14.3497, 108.0005),
    ('VN-01', 'Lai Châu', 22.3862, 103.4703),
    ('VN-35', 'Lâm Đồng', 11.5753, 108.1429),
    ('VN-09', 'Lạng Sơn', 21.8537, 106.7615),
    ('VN-02', 'Lào Cai', 22.4809, 103.9755),
    ('VN-41', 'Long An', 10.6956, 106.2431),
    ('VN-67', 'Nam Định', 20.4388, 106.1621),
    ('VN-22', 'Nghệ An', 19.2342, 104.9200),
    ('VN-18', 'Ninh Bình', 20.2506, 105.9745),
    ('VN-36', 'Ninh Thuận', 11.6739, 108.8630),
    ('VN-68', 'Phú Thọ', 21.4220, 105.2297),
    ('VN-32', 'Phú Yên', 13.0882, 109.0929),
    ('VN-24', 'Quảng Bình', 17.6103, 106.3487),
    ('VN-27', 'Quảng Nam', 15.5394, 108.0191),
    ('VN-29', 'Quảng Ngãi', 15.1214, 108.8044),
    ('VN-13', 'Quảng Ninh', 21.0064, 107.2925),
    ('VN-25', 'Quảng Trị', 16.7943, 106.9634),
    ('VN-52', 'Sóc Trăng', 9.6025, 105.9739),
    ('VN-05', 'Sơn La', 21.3269, 103.9144),
    ('VN-37', 'Tây Ninh', 11.3352, 106.1099),
    ('VN-20', 'Thái Bình', 20.4463, 106.3366),
    ('VN-69', 'Thái Nguyên', 21.5672, 105.8252),
    ('VN-21', 'Thanh Hóa', 19.8067, 105.7852),
    ('VN-26', 'Thừa Thiên Huế', 16.4674, 107.5905),
    ('VN-46', 'Tiền Giang', 10.4493, 106.3421),
    ('VN-51', 'Trà Vinh', 9.9513, 106.3346),
    ('VN-07', 'Tuyên Quang', 21.7767, 105.2280),
    ('VN-49', 'Vĩnh Long', 10.2396, 105.9572),
    ('VN-70', 'Vĩnh Phúc', 21.3609, 105.5474),
    ('VN-06', 'Yên Bái', 21.7168, 104.8986)
"""


def residential_prices(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"SELECT tier, description, CAST(price AS DECIMAL(12,2)) AS price "
        f"FROM VALUES {RESIDENTIAL_PRICES} AS seed(tier, description, price)"
    )


def _band_prices(spark: SparkSession, values: str) -> DataFrame:
    return spark.sql(
        f"SELECT voltage_tier, time_of_day, CAST(price AS DECIMAL(12,2)) AS price "
        f"FROM VALUES {values} AS seed(voltage_tier, time_of_day, price)"
    )


def commercial_prices(spark: SparkSession) -> DataFrame:
    return _band_prices(spark, COMMERCIAL_PRICES)


def industrial_prices(spark: SparkSession) -> DataFrame:
    return _band_prices(spark, INDUSTRIAL_PRICES)


def business_prices(spark: SparkSession) -> DataFrame:
    """Both band price lists, told apart by ``customer_type``."""
    return spark.sql(
        f"SELECT customer_type, voltage_tier, time_of_day, CAST(price AS DECIMAL(12,2)) AS price FROM ("
        f"SELECT 'commercial' AS customer_type, * FROM VALUES {COMMERCIAL_PRICES} AS c(voltage_tier, time_of_day, price) "
        f"UNION ALL "
        f"SELECT 'industrial' AS customer_type, * FROM VALUES {INDUSTRIAL_PRICES} AS i(voltage_tier, time_of_day, price))"
    )


def provinces(spark: SparkSession) -> DataFrame:
    return spark.sql(
        f"SELECT location, iso_code, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude "
        f"FROM VALUES {PROVINCES} AS seed(iso_code, location, latitude, longitude)"
    )
