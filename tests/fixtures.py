"""Ticks and expected reports (FIXTURES.md F1, F2): fixed values of the reference job's tests."""

TICK_COLUMNS = ["ISIN", "Mnemonic", "Date", "Time", "StartPrice", "EndPrice", "MinPrice", "MaxPrice",
                "TradedVolume"]
TICK_DDL = ("ISIN string, Mnemonic string, Date string, Time string, StartPrice double, "
            "EndPrice double, MinPrice double, MaxPrice double, TradedVolume bigint")

F1 = [
    ("AT0000A0E9W5", "SANT", "2021-04-15", "12:00", 20.19, 18.45, 18.20, 20.33, 877),
    ("AT0000A0E9W5", "SANT", "2021-04-16", "15:00", 18.27, 21.19, 18.27, 21.34, 987),
    ("AT0000A0E9W5", "SANT", "2021-04-17", "13:00", 20.21, 18.27, 18.21, 20.42, 633),
    ("AT0000A0E9W5", "SANT", "2021-04-17", "14:00", 18.27, 21.19, 18.27, 21.34, 455),
    ("AT0000A0E9W5", "SANT", "2021-04-18", "07:00", 20.58, 19.27, 18.89, 20.58, 9066),
    ("AT0000A0E9W5", "SANT", "2021-04-18", "08:00", 19.27, 21.14, 19.27, 21.14, 1220),
    ("AT0000A0E9W5", "SANT", "2021-04-19", "07:00", 23.58, 23.58, 23.58, 23.58, 1035),
    ("AT0000A0E9W5", "SANT", "2021-04-19", "08:00", 23.58, 24.22, 23.31, 24.34, 1028),
    ("AT0000A0E9W5", "SANT", "2021-04-19", "09:00", 24.22, 22.21, 22.21, 25.01, 1523),
]

F1_FILES = [f"{r[2]}/{r[2]}_BINS_XETR{r[3][:2]}.csv" for r in F1]

REPORT_COLUMNS = ["ISIN", "Date", "opening_price_eur", "closing_price_eur", "minimum_price_eur",
                  "maximum_price_eur", "daily_traded_volume", "change_prev_closing_%"]

F2 = [
    ("AT0000A0E9W5", "2021-04-17", 20.21, 18.27, 18.21, 21.34, 1088, 10.62),
    ("AT0000A0E9W5", "2021-04-18", 20.58, 19.27, 18.89, 21.14, 10286, 1.83),
    ("AT0000A0E9W5", "2021-04-19", 23.58, 24.22, 22.21, 25.01, 3586, 14.58),
]

F2_CLOSE_CHANGE = [0.00, 5.47, 25.69]


def write_tick_csvs(base, rows, names=None, columns=TICK_COLUMNS):
    """One CSV per row at ``base/<name>``, header included (the reference's layout)."""
    import os
    names = names or [f"{r[2]}/{r[2]}_BINS_XETR{r[3][:2]}.csv" for r in rows]
    for name, row in zip(names, rows):
        p = os.path.join(base, name)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "a" if os.path.exists(p) else "w") as fh:
            if fh.tell() == 0:
                fh.write(",".join(columns) + "\n")
            fh.write(",".join(str(v) for v in row) + "\n")
