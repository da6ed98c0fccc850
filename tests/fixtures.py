"""Hand-written raw rows: one or more per rule the pipeline must honour."""

import datetime as dt

AS_OF = dt.date(2025, 6, 30)


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


# ingested_at, source_file, report_date, amazon_order_id, purchase_date,
# last_updated_date, order_status, fulfillment_channel, order_total, currency,
# ship_country, buyer_id
MARKETPLACE = [
    # A-1: two reports; the later update wins (RETURNED); other file date.
    (ts("2025-06-02 08:00"), "reports/2025-06-02.tsv", dt.date(2025, 6, 2), "A-1", ts("2025-06-01 10:00"),
     ts("2025-06-02 07:00"), "Shipped", "AFN", 100.0, "EUR", "DE", "b1"),
    (ts("2025-06-05 08:00"), "reports/2025-06-04.tsv", dt.date(2025, 6, 5), " A-1 ", ts("2025-06-01 10:00"),
     ts("2025-06-04 12:00"), "Returned", "MFN", 100.0, "EUR", "DE", "b1"),
    # A-2: same update time, the later ingest wins (CANCELLED); no date and
    # an impossible date in the file names.
    (ts("2025-06-03 10:00"), "reports/orders.tsv", dt.date(2025, 6, 3), "A-2", ts("2025-06-02 09:00"),
     ts("2025-06-03 09:00"), "pending", "MFN", 50.0, "USD", "US", "b2"),
    (ts("2025-06-04 10:00"), "reports/2025-13-45.tsv", dt.date(2025, 6, 4), "A-2", ts("2025-06-02 09:00"),
     ts("2025-06-03 09:00"), "Cancelled", "MFN", 50.0, "USD", "US", "b2"),
    # A-3: tab / no-break / ideographic space padding, 2.675 rounds to 2.68,
    # blank file name.
    (ts("2025-06-03 12:00"), "", dt.date(2025, 6, 3), "\tA-3\u00a0", ts("2025-06-03 08:00"),
     None, "\u3000complete ", "afn", 2.675, " eur\n", "de ", "b3"),
    # A-4: unknown status and channel, negative total, invalid currency and
    # country, future purchase, ingested and updated before the purchase,
    # NULL file name, no buyer.
    (ts("2025-12-31 10:00"), None, None, "A-4", ts("2026-01-01 10:00"),
     ts("2025-12-30 10:00"), "weird", "fbx", -5.0, "EU1", "DEU", None),
    # Blank ids: they share the NULL-id group with a storefront row.
    (ts("2010-01-02 10:00"), "reports/2010-01-02.tsv", None, "", ts("2009-12-31 10:00"),
     None, None, None, None, "", None, "  "),
    (ts("2010-01-03 10:00"), "reports/2010-01-03.tsv", None, " ", ts("2009-12-31 11:00"),
     None, "shipped", "MFN", 1.0, "EUR", "FR", None),
    # A-7: zero total is eligible; lag of 3 days is late.
    (ts("2025-06-13 10:00"), "reports/2025-06-13.tsv", dt.date(2025, 6, 13), "A-7", ts("2025-06-10 10:00"),
     None, "UNSHIPPED", "MFN", 0.0, "CHF", "CH", "b7"),
    # No purchase date: NULL flag set, future/too-old flags FALSE; blank id,
    # and with no event time it loses the NULL-id group.
    (ts("2025-06-20 10:00"), "reports/2025-06-20.tsv", None, "", None,
     None, "pending", "MFN", 1.0, "EUR", "DE", "b9"),
]

# id, created_at, processed_at, financial_status, fulfillment_status, currency,
# total_price, subtotal_price, total_discounts, total_tax, shipping_country,
# customer_id, email, tags, test
STOREFRONT = [
    # Paid but fulfilment cancelled: still eligible.
    ("S-1", ts("2025-06-01 12:00"), ts("2025-06-01 12:05"), "paid", "cancelled", "EUR", 49.9, 40.0, 0.0, 9.9,
     "DE", "c1", "x@shop.test", None, False),
    # test NULL -> is_test_order NULL, still eligible; padded status.
    ("S-2", ts("2025-06-02 12:00"), None, " Pending ", None, "usd", 10.0, 8.0, 0.0, 2.0,
     "us", "c1", None, "vip", None),
    # Refunded with a missing tax: not eligible.
    ("S-3", ts("2025-06-03 12:00"), ts("2025-06-03 12:10"), "refunded", "fulfilled", "EUR", 20.0, 16.0, 0.0,
     None, "DE", "c2", "y@shop.test", None, False),
    # Test order: not eligible.
    ("S-4", ts("2025-06-04 12:00"), ts("2025-06-04 12:10"), "paid", None, "EUR", 30.0, 24.0, 0.0, 6.0,
     "DE", "c2", None, None, True),
    # Only whitespace as id: joins the NULL-id group.
    ("\u00a0", ts("2025-06-04 13:00"), None, "paid", None, "EUR", 1.0, None, None, None,
     "DE", "c3", None, None, False),
    # S-6: two versions; the later processing time wins (REFUNDED).
    ("S-6", ts("2025-06-05 12:00"), ts("2025-06-05 13:00"), "paid", None, "EUR", 12.0, None, None, None,
     "NL", "c6", None, None, False),
    ("S-6 ", ts("2025-06-05 12:00"), ts("2025-06-08 13:00"), "refunded", None, "EUR", 12.0, None, None, None,
     "NL", "c6", None, None, False),
    # c1 has one EUR and two USD eligible orders: primary USD, 2 currencies.
    ("S-7", ts("2025-06-07 12:00"), None, "paid", None, "USD", 15.0, None, None, None,
     "US", "c1", "a@shop.test", None, False),
    # c4: one order with no currency and one in EUR: the NULL currency wins.
    ("S-8", ts("2025-06-08 12:00"), None, "paid", None, "", 5.0, None, None, None, "FR", "c4", None, None, False),
    ("S-9", ts("2025-06-09 12:00"), None, "paid", None, "EUR", 5.0, None, None, None, "FR", "c4", None, None,
     False),
    # c5: CHF and AUD tied: the smallest code wins.
    ("S-10", ts("2025-06-10 12:00"), None, "paid", None, "CHF", 7.0, None, None, None, "CH", "c5", None, None,
     False),
    ("S-11", ts("2025-06-11 12:00"), None, "paid", None, "AUD", 7.0, None, None, None, "AU", "c5", None, None,
     False),
    # No status and no customer: flags NULL, still eligible, not in the dimension.
    ("S-12", ts("2025-06-12 12:00"), None, None, None, "EUR", 3.0, None, None, None, "DE", "", None, None,
     False),
    # No creation date and a blank id: loses the NULL-id group.
    ("", None, None, "paid", None, "EUR", 2.0, None, None, None, "DE", "c9", None, None, False),
]
