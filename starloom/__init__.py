"""starloom: a Spark-native star-schema warehouse toolkit.

Load order/item/payment/review/customer/product/seller extracts, build
date, customer, product, seller and payment-type dimensions with dense
surrogate keys, build the four facts, check the result as a DataFrame,
write it to CSV, parquet tables or JDBC, and answer the usual business
questions over it.  Everything is DataFrame / SQL work planned by Catalyst.
"""

from starloom.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
