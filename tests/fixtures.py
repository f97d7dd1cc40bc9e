"""Own sample incidents and the results expected of them (FIXTURES.md).

Invented data: one district and one category, four months, one pair of rows
out of order by less than a day in each of two places.  The expected values
were derived with DuckDB from the rows, not with this package."""

from blotter.functions.format import ALERT_TEMPLATE

HEADER = "ID,Date,IUCR,Arrest,Domestic,District,ComArea,Latitude,Longitude"

FILE_1 = [
    "101,2021-01-04T09:30:00.000Z,0310,True,False,4.0,12.0,52.1,4.3",
    "102,2021-01-04T21:15:00.000Z,0311,False,True,4.0,12.0,52.1,4.3",
    "103,2021-01-19T06:00:00.000Z,0310,True,True,4.0,12.0,52.1,4.3",
    "104,2021-02-11T12:00:00.000Z,0311,False,False,4.0,12.0,52.1,4.3",
    "105,2021-02-11T12:45:00.000Z,0310,True,False,4.0,12.0,52.1,4.3",
    "106,2021-02-27T03:10:00.000Z,0310,False,False,4.0,12.0,52.1,4.3",
]
FILE_2 = [
    "107,2021-03-08T17:20:00.000Z,0311,False,True,4.0,12.0,52.1,4.3",
    "108,2021-03-30T08:00:00.000Z,0310,True,False,4.0,12.0,52.1,4.3",
    "109,2021-03-29T19:40:00.000Z,0311,False,False,4.0,12.0,52.1,4.3",
    "110,2021-04-06T11:55:00.000Z,0310,False,True,4.0,12.0,52.1,4.3",
    "111,2021-04-14T10:00:00.000Z,0311,True,False,4.0,12.0,52.1,4.3",
    "112,2021-04-21T22:05:00.000Z,0310,False,False,4.0,12.0,52.1,4.3",
    "113,2021-04-21T05:00:00.000Z,0310,True,False,4.0,12.0,52.1,4.3",
    "114,2021-04-23T00:30:00.000Z,0311,False,False,4.0,12.0,52.1,4.3",
]
DISTRICT = 4
LAST_OF_MONTH = {103, 106, 109, 114}

CODE_HEADER = "IUCR,PRIMARY DESCRIPTION,SECONDARY DESCRIPTION,INDEX CODE"
CODES_SMALL = [
    "310,PIRACY,BOARDING AT ANCHOR,I",
    "311,PIRACY,CARGO TAKEN IN PORT,N",
    "320,SMUGGLING,TEA AND COFFEE,I",
    "321,SMUGGLING,SALT,N",
]
CODES_QUOTED = [
    "910,WRECKING,FALSE LIGHTS,I",
    '915,WRECKING,"LIGHTS, BELLS, BUOYS MOVED",I',
]

# month -> (count, arrest, domestic, monitored)
MONTHLY = {1: (3, 2, 2, 2), 2: (3, 1, 0, 2), 3: (3, 1, 1, 1), 4: (5, 2, 1, 3)}
CLOSED = {1, 2, 3}

# (count, monitored, percent, windows, first start, closed)
SLIDING = [
    (2, 1, 50.0, 40, "2020-12-06", True),
    (3, 2, 66.66666666666666, 38, "2020-12-21", True),
    (1, 1, 100.0, 8, "2021-01-05", True),
    (4, 2, 50.0, 13, "2021-02-07", True),
    (2, 0, 0.0, 1, "2021-02-28", True),
    (3, 1, 33.33333333333333, 7, "2021-03-01", True),
    (6, 4, 66.66666666666666, 1, "2021-03-23", True),
    (6, 4, 66.66666666666666, 2, "2021-03-24", False),
    (7, 4, 57.14285714285714, 5, "2021-03-25", False),
    (5, 3, 60.0, 7, "2021-03-31", False),
    (4, 2, 50.0, 8, "2021-04-07", False),
    (3, 2, 66.66666666666666, 7, "2021-04-15", False),
    (1, 0, 0.0, 2, "2021-04-22", False),
]
WINDOWS, CLOSED_WINDOWS = 139, 108
ALERTS = 47                       # closed windows above 60 % (and above 50 %)
OPEN_ABOVE_50, OPEN_ABOVE_60, EXACTLY_60 = 68, 56, 7

# mode A: the count of each row in order of arrival, and April's monitored counts
RUNNING = [1, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 4, 5]
RUNNING_MONITORED_APRIL = [1, 1, 2, 3, 3]

FIRST_ALERT = ALERT_TEMPLATE.format(start="2020-12-21T00:00", end="2021-01-20T00:00", district=DISTRICT, count=3, monitored=2,
                                    percentage="66.66666666666666")
