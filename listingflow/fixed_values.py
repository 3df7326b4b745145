"""Word lists, patterns and column layouts that the results depend on.

Rule lists are ordered; every rule sees the text the previous rule left.
"""

from __future__ import annotations

UNKNOWN = "-"
NONE_TEXT = "无"

# Ids above this value are typed in by hand and never touched by automatic jobs.
MANUAL_ID_THRESHOLD = 1_111_111_000

# --- gearbox ---------------------------------------------------------------
GEARBOX_RULES = (
    (r"CVT无级变速|无级变速|自动.*CVT|CVT.*自动|-CVT|CVT", "自动"),
    (r"双离合.*手自动一体", "自动"),
    (r"手自一体型|手自动一体型|手自动一体|手自一体|tiptronic", "自动"),
    (r"DSG双离合|双离合器|双离合|G-DCT|DCT|DSG", "自动双离合"),
    (r"[^a-zA-Z0-9]AT|[-\s]\dAT|AT[\s-]", "自动"),
    (r"AT(?![a-zA-Z0-9])", "自动"),
    (r"AMT智能手动版|AMT智能手动|AMT|EMT|IMT", "自动"),
    (r"(?<![a-zA-Z])MT(?![a-zA-Z])|\dMT|MT[-\s]", "手动"),
    (r"(?i)^manual", "手动"),
)
GEARBOX_KINDS = "自动双离合|自动|手动"
ELECTRIC_GEARBOX = "电动"

GEARBOX_MATCH_RULES = (
    (r"CVT无级变速|无级变速|CVT", "自动"),
    (r"双离合", "自动双离合"),
    (r"手自一体", "自动"),
    (r"^[Aa]uto.*", "自动"),
    (r"^[Mm]anual.*", "手动"),
)

DRIVE_RULES = (
    (r"四驱|AWD|4WD|4X4|4x4", "四驱"),
    (r"两驱|FWD|RWD|2WD", "两驱"),
)

# --- emission standard -----------------------------------------------------
EMISSION_MARK = "国|欧|京"
EMISSION_IN_NAME = (
    r"((?:国|欧|京)(?:Ⅱ|Ⅲ|Ⅳ|III|II|IV|VI|Ⅵ|V|二|三|四|五|2|3|4|5)(?:型|)|京(?:5|五|V))"
)
EMISSION_RULES = (
    (r"化油器", ""),
    (r"3|III|Ⅲ", "三"),
    (r"2|Ⅱ|II", "二"),
    (r"4|IV|Ⅳ", "四"),
    (r"6|VI|Ⅵ", "六"),
    (r"5|V|Ⅴ", "五"),
    (r"1|I|Ⅰ", "一"),
    (r"\+OBD|\)", ""),
    (r"带OBD", ""),
    (r"\(", "/"),
)
EMISSION_PRODUCTION_RULES = (
    (r"\+OBD|\)", ""),
    (r"3|III|Ⅲ", "三"),
    (r"2|Ⅱ|II", "二"),
    (r"4|IV|Ⅳ", "四"),
    (r"6|VI|Ⅵ", "六"),
    (r"5|V", "五"),
    (r"\(", "/"),
    (r"未知", "-"),
)
EMISSION_MATCH_NOISE = r"\+OBD|OBD"

# --- displacement, model year, status, level -------------------------------
DISPLACEMENT = r"(\d+\.\d)"
DISPLACEMENT_MATCH = r"(\d+\.?\d*)"
MODEL_YEAR_NOISE = r"其它|其他"
MODEL_YEAR_LONG = r"([12]\d{3})款"
MODEL_YEAR_SHORT = r"(\d{2})款"
SALE_STATUS = r"(停售|在售|即将销售)"
COMING_SOON = "即将销售"
CAR_LEVELS = (
    "紧凑型SUV|中型SUV|紧凑型车|中大型车|中型车|中大型SUV|大型SUV|大型车|微型车|小型车|MPV|"
    "跑车|小型SUV|微面|皮卡|微卡|轻客|客车|紧凑型MPV|卡车|中大型MPV|其它|货车|重卡"
)
# fuel words and their power code, first hit wins
POWER_CODES = (("纯电", 1), ("油电", 2), ("插电", 3), ("增程", 4))

# --- import naming ---------------------------------------------------------
IMPORT_MARK = "进口"
IMPORT_REPEATS = r"进口进口进口|进口进口"
IMPORT_SUFFIX = r"\(进口\)"
IMPORT_OR_STOPPED_SUFFIX = r"\(进口\)|\(停售\)"
SERIES_NAME_FIX = ("欧尚COSMOS(科尚)", "欧尚COSMOS-科尚")

# --- electric-drive parameters ---------------------------------------------
EV_TYPE_RULES = ((r"/| ", ""), (r"后", "/后"))
EV_CHARGING_TIME_RULES = ((r"标配|选配|待查", "-"),)
EV_BATTERY_KINDS = r"(三元镍钴锰酸锂|磷酸铁锂|三元锂|锂离子|钴酸锂|锰酸锂|镍钴锰|高压锂|镍氢)"
EV_BATTERY_SUFFIX = "电池"
EV_RANGE_RULES = ((r"标配|选配", "-"), (r"km|公里", ""))
EV_WARRANTY_RULES = (
    (r"三", "3"),
    (r"四", "4"),
    (r"五", "5"),
    (r"六", "6"),
    (r"八", "8"),
    (r"十", "10"),
    (r"待查", "-"),
    (r"或| ", ""),
)
EV_TEXT_COLUMNS = (
    "ee_type", "ee_total_power", "ee_total_torque",
    "ee_front_max_kw", "ee_front_max_Nm", "ee_after_max_kw", "ee_after_max_Nm",
    "ee_system_integrated_kw", "ee_system_integrated_Nm",
    "ee_driving_number", "ee_layout", "ee_battery_type",
    "ee_pure_electric_range", "ee_battery_capacity", "ee_power_consumption",
    "ee_battery_quality_assurance", "ee_fast_charging_time",
    "ee_slow_charging_time", "ee_fast_charge",
)
EV_FAST_CHARGE_PRODUCTION = "ee_fast_charge(%)"

# --- equipment -------------------------------------------------------------
FRONT_COLUMNS = (
    "master_air_bag", "front_side_air_bag", "front_head_air_bag", "front_parking_radar",
    "front_seat_heating", "front_seat_ventilation", "front_electric_window",
)
REAR_COLUMNS = (
    "sub_air_bag", "rear_side_air_bag", "rear_head_air_bag", "rear_parking_radar",
    "rear_seat_heating", "rear_seat_ventilation", "rear_electric_window",
)
# a literal backslash, then a slash (as a pattern)
PAIR_SEPARATOR = r"\\/"
EQUIPMENT_RULES = (
    (r"前标配|后标配|主标配|副标配|标配", "Y"),
    (r"前选配|后选配|主选配|副选配|选配", "-"),
    (r"前无|后无|主无|副无|无", "N"),
    (r"前-|后-|主-|副-|-", "N"),
)
# what the rules make of the plain values
EQUIPMENT_PLAIN = {"标配": "Y", "选配": "N", "无": "N", "-": "N"}
EQUIPMENT_COLUMNS = (
    "master_air_bag", "sub_air_bag", "front_side_air_bag", "rear_side_air_bag",
    "front_head_air_bag", "rear_head_air_bag", "front_parking_radar", "rear_parking_radar",
    "front_seat_heating", "rear_seat_heating", "front_seat_ventilation", "rear_seat_ventilation",
    "electric_roof", "panoramic_roof", "multifunction_steering_wheel", "cruise",
    "front_electric_window", "rear_electric_window", "mirror_electric_adjustment",
    "mirror_heating", "air_conditioning_control_mode", "color_outside", "color_outside_code",
    "gps", "low_beam_lamp", "daytime_running_light", "automatic_headlights", "front_fog_lamp",
    "tire_pressure_monitoring", "ISOFIX_child_seat_interfaces", "car_internal_lock",
    "keyless_start_system", "abs", "brake_assist", "stability_control", "variable_suspension",
    "seat_material", "electric_seat_memory",
)

# --- model detail layout (source order) ------------------------------------
DETAIL_TEXT_COLUMNS = (
    "emission", "level", "engine", "gear_box", "length", "width", "height", "body_structure",
    "seat_number", "wheelbase", "weight", "trunk_volume", "intake", "cylinder_arrangement",
    "cylinders", "admission_gear", "max_ps", "max_n_m", "fuel", "fuel_grade",
    "fuel_supply_system", "environmental_standards_org", "drive_mode", "front_suspension_type",
    "rear_suspension_type", "power_type", "car_boty_type", "front_brake_type",
    "rear_brake_type", "parking_brake_type", "front_tire_specifications",
    "rear_tire_specifications", "master_air_bag", "sub_air_bag", "front_side_air_bag",
    "rear_side_air_bag", "front_head_air_bag", "rear_head_air_bag", "tire_pressure_monitoring",
    "ISOFIX_child_seat_interfaces", "car_internal_lock", "keyless_start_system", "abs",
    "brake_assist", "stability_control", "variable_suspension", "electric_roof",
    "panoramic_roof", "multifunction_steering_wheel", "cruise", "front_parking_radar",
    "rear_parking_radar", "reverse_video_image", "seat_material", "electric_seat_memory",
    "front_seat_heating", "rear_seat_heating", "front_seat_ventilation",
    "rear_seat_ventilation", "gps", "low_beam_lamp", "daytime_running_light",
    "automatic_headlights", "front_fog_lamp", "front_electric_window", "rear_electric_window",
    "mirror_electric_adjustment", "mirror_heating", "air_conditioning_control_mode",
    "color_outside", "color_outside_code",
)
DETAIL_COLUMNS = ("autohome_id", *DETAIL_TEXT_COLUMNS, "url", "update_time")
TORQUE_PRODUCTION = "max_n-m"

# --- listings --------------------------------------------------------------
CITY_ALIASES = (("襄樊", "襄阳"), ("杨凌", "咸阳"), ("农垦系统", "哈尔滨"))
BRACKET_NOISE = r"[\(（][^\)）]*[\)）]"
CITY_SUFFIX = "市"
LISTING_COLOR_RULES = (
    (r"――|-|无数据|null|[0-9]", ""),
    (r"其他", "其它"),
    (r"色", ""),
    (r"浅|深|象牙|冰川", ""),
)
CATALOGUE_COLOR_RULES = ((r"无", ""), (r";+$", ""))
TRANSFER_NOISE = r".*数据|NA"
TEXT_NOISE = r"NA"
FEE_EXCLUDED, FEE_INCLUDED = "不含", "含"
EARLIEST_MARK = "2000-01-01"
EARLIEST_REGISTRATION = "2000-01-01"
MIN_PRICE_RATIO, MAX_PRICE_RATIO, USED_PRICE_RATIO = 0.05, 1.5, 1.0
MAX_GAP_OF_PAID, MAX_GAP_OF_GUIDE = 3, 2
SHIFTED_EMISSION = r"^[0-9]+$"
SHIFTED_FUEL = r"R[0-9]"

LISTING_COLUMNS = (
    "car_platform", "id_data_input", "id_che300", "std_modelid", "model_year", "std_brandid",
    "std_seriesid", "is_import", "is_green", "brand", "series", "model_name", "color", "liter",
    "auto", "discharge_standard", "car_level", "location", "regDate", "quotes", "model_price",
    "mile", "state", "trans_fee", "transfer", "annual", "insure", "add_time", "update_time",
    "province", "car_country", "user_years", "partition_month", "date_add",
)

# --- cross-platform match --------------------------------------------------
MATCH_PLATFORMS = ("autohome", "czb", "souhu", "yiche", "che58", "youxin", "autoowner")
MATCH_FIELDS = (
    "car_year", "car_name", "car_series1", "car_liter_wu",
    "car_auto", "car_price", "car_drive", "car_discharge",
)
MATCH_ROUNDS = (
    MATCH_FIELDS,
    MATCH_FIELDS[:6],
    MATCH_FIELDS[:5],
    MATCH_FIELDS[:4],
    (*MATCH_FIELDS[:3], "car_price"),
    MATCH_FIELDS[:3],
)
DECIDED_EXCEPT = (0, 4)
RECENT_REG_YEAR = 2019
