"""How carrier files name their columns."""

from __future__ import annotations

from flightloom.operators import schema_drift

#: The headers under which carrier files carry each field.
CARRIER_HEADERS = {
    "passengers": ("Passengers", "Pax Carried", "Revenue Pax", "Psgrs"),
    "aircraft_km": ("Aircraft Km", "Aircraft Kilometres Flown", "AKM", "Km Flown"),
    "passenger_km": ("Passenger Km", "Pax Kilometres Performed", "RPK", "Passenger Km in Mn", "PKM (000)"),
    "seat_km": ("Seat Km", "Available Seat Kilometres", "ASK", "Capacity Km"),
    "freight_tonnes": ("Freight Tonnes", "Freight", "Cargo (t)", "Frt", "Freight Carried in Kg"),
    "mail_tonnes": ("Mail Tonnes", "Mail", "Post (t)"),
    "total_tonne_km": ("Total Tonne Km", "Tonne Km Performed", "RTK"),
    "available_tonne_km": ("Available Tonne Km", "Capacity Tonne Km", "ATK"),
    "passenger_load_factor": ("Passenger Load Factor", "PLF", "Pax L/F", "Seat Factor"),
    "weight_load_factor": ("Weight Load Factor", "WLF", "Load Factor by Weight", "Wt. L.F."),
}
CARRIER_FILES = schema_drift.Target(
    keys=("airline", "type", "year", "month"),
    aliases=CARRIER_HEADERS,
    units={"Passenger Km in Mn": 10.0, "PKM (000)": 0.1, "Freight Carried in Kg": 0.001},
    comma_decimals=("passenger_load_factor", "weight_load_factor"),
)
