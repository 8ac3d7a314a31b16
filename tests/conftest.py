import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[*]", 8, **{
        "spark.ui.enabled": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EVENT = {
    "order_id": "o1", "event_timestamp": "2024-05-05T10:00:01", "order_timestamp": "2024-05-05T09:30:00",
    "customer_id": "c1", "customer_name": "Asha", "customer_city": "Pune", "customer_region": "West",
    "customer_age": 30, "customer_gender": "Female", "product_id": "p1", "product_name": "Lamp",
    "category": "Books", "brand": "Acme", "unit_price": 50.0, "store_id": "s1", "store_name": "Main",
    "store_type": "Online", "store_city": "Pune", "store_region": "West", "quantity": 2, "total_amount": 100.0,
    "tax_amount": 18.0, "final_amount": 118.0, "payment_method": "UPI", "order_status": "Placed",
    "is_first_order": True, "device_type": "Mobile", "source": "App",
}


@pytest.fixture
def event():
    """One clean event, with changes by keyword."""
    return lambda **changes: {**EVENT, **changes}
