"""Schemas of the file inputs. Jobs never infer types."""

from __future__ import annotations

# Column names and types of the monthly flight file, in file order.
FLIGHTS = """
    year int, month int, flight_dt string, carrier_code string, tail_num string, carrier_flight_num string,
    origin_code string, origin_city_name string, dest_code string, dest_city_name string,
    scheduled_dep_tm string, actual_dep_tm string, dep_delay_min double, dep_delay_group_num double,
    wheels_off_tm string, wheels_on_tm string, scheduled_arr_tm string, actual_arr_tm string,
    arr_delay_min double, arr_delay_group_num double, cancelled_flg double, cancellation_code string,
    flights_cnt double, distance double, distance_group_num double, carrier_delay_min double,
    weather_delay_min double, nas_delay_min double, security_delay_min double, late_aircraft_delay_min double
"""

# A header-less list of people with three amounts.
PEOPLE = "first_name string, last_name string, age int, amount_1 double, amount_2 double, amount_3 double"

# Titanic passengers.
PASSENGERS = """
    PassengerId int, Survived int, Pclass int, Name string, Sex string, Age double, SibSp int, Parch int,
    Ticket string, Fare double, Cabin string, Embarked string
"""
