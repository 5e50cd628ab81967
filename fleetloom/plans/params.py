"""Run parameters of the registered queries."""

from __future__ import annotations

from fleetloom.functions.config_key import RemapRules

AS_OF, TARGET = "1998-01-01", "2001-09-01"
FORECAST_ID = 3
DAILY_RATE = 60.0
RUN_DATE = "2001-01-01"
EXCLUDE_SOURCE = "%FLEET%"
LAUNCH_SOURCE = "%Launch%"
LAUNCH_BUILDS = ("BLD-LAUNCH",)
PAINT_PAIRS = {("EXP-BLUE", "INT-2"): "Blue x Slate", ("EXP-GREEN", "INT-1"): "Green x Black"}
HISTORY = ("1999-01-04", "2000-12-31")
LANE_MONTH = "2001-06-01"
LEAD_TIME_FACTORY, SIGMA_FACTORY, SIGMA_FIELD = 2.0, 0.25, 0.3
EXCLUDED_PAINT = "EXP-RED"

REMAP = RemapRules(
    interior={"INT-0": "INT-1"},
    premium_powertrains=("LARGE", "MEDIUM"),
    premium_wheels={"WHL-0": "WHL-2"},
    tonneau_models=("M2 LARGE", "M2 MEDIUM"),
    tonneau={"TON-NULL": "TON-P02"},
    badging={"STANDARD": "ACTBDG-BRT", "PROMO": "ACTBDG-DRK"},
    base_configs=(
        "2025_US_M1 STANDARD_EXP-RED_INT-0_WHL-0_AUD-STD_ROOF-FGP_TON-NULL_ACTBDG-DRK_UTL-S01",
        "2025_US_M2 STANDARD_EXP-RED_INT-0_WHL-0_AUD-STD_ROOF-FGP_TON-NULL_ACTBDG-DRK_UTL-T01",
    ),
    utility={"M1 STANDARD": "UTL-S01", "M2 STANDARD": "UTL-T01", "M1 LARGE": "UTL-S01",
             "M1 MEDIUM": "UTL-S01", "M2 LARGE": "UTL-T01", "M2 MEDIUM": "UTL-T01"},
)

# Option groups of the relaxed matching steps: column → (option, {option: group}).
GROUPS = {
    "exterior_agnostic_grouped": ("exterior", {"EXP-RED": "warm", "EXP-BLUE": "cool", "EXP-GREEN": "cool"}),
    "interior_agnostic_grouped": ("interior", {"INT-0": "light", "INT-1": "dark", "INT-2": "dark"}),
    "wheels_agnostic_grouped": ("wheels", {"WHL-0": "small", "WHL-1": "small"}),
    "badging_agnostic": ("", {}),
    "camp_speaker_agnostic": ("", {}),
    "mats_agnostic": ("", {}),
    "utility_panel_agnostic": ("", {}),
    "tonneau_agnostic": ("", {}),
    "audio_agnostic": ("", {}),
    "offroad_agnostic": ("", {}),
    "atp_agnostic": ("", {}),
    "agnostic_motor": ("motor", {"MOT-0": "dual", "MOT-1": "dual"}),
    "total_trim_agnostic": ("", {}),
    "total_motor_agnostic": ("", {}),
    "total_battery_agnostic": ("", {}),
    "total_exterior_agnostic": ("", {}),
    "total_interior_agnostic": ("", {}),
    "total_wheel_agnostic": ("", {}),
    "roof_agnostic": ("", {}),
}
