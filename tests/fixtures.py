"""Small hand-made files. The three layouts hold the same logical rates."""

import json

BOM = "\ufeff"
META = f"{BOM}hospital_name,last_updated_on,version,,license|TN\n\"General, \"\"Old\"\" Hospital\",1/1/2026,2.0.0\n"

TALL = META + (
    "description,code|1,code|1|type,code|2,code|2|type,modifiers,setting,billing_class,standard_charge|gross,"
    "standard_charge|min,standard_charge|max,payer_name,plan_name,standard_charge|negotiated_dollar,"
    "standard_charge|negotiated_percentage,standard_charge|negotiated_algorithm,standard_charge|methodology,,description\n"
    '"Knee ""total""\nreplacement",27447,CPT,K1,CDM,,Outpatient,facility,50000,1,2,Aetna,PPO,20000.50,,,case rate,,\n'
    '"Knee ""total""\nreplacement",27447,CPT,K1,CDM,,Outpatient,facility,50000,1,2,O\'Neil,P|1,,45,,fee,,\n'
    '"Knee ""total""\nreplacement",27447,CPT,K1,CDM,,Outpatient,facility,50000,1,2,Gov,HMO,"12,5",,,fee,,\n'
    "Hip,27130,cpt,H1,CDM, 52 ,Both,professional,,,,Aetna,PPO,,,per contract,fee,,\n"
    "Hip,27130,cpt,H1,CDM, 52 ,Both,professional,,,,Gov,HMO,, ,,fee,,\n"
    "Other,99999,CPT,O1,CDM,,Both,facility,,,,Aetna,PPO,7,,,fee,,\n"
)

_PAYERS = [("Aetna", "PPO"), ("O'Neil", "P|1"), ("Gov", "HMO")]
_METRICS = ["negotiated_dollar", "negotiated_percentage", "negotiated_algorithm", "methodology"]
_WIDE_COLUMNS = [
    "description", "code|1", "code|1|type", "code|2", "code|2|type", "modifiers", "setting", "billing_class",
    "standard_charge|gross", "standard_charge|min", "standard_charge|max",
    *[f"standard_charge|{p}|{q}|{m}" for p, q in _PAYERS for m in _METRICS],
]


def _wide_row(cells: list[str], *groups: list[str]) -> str:
    flat = cells + [c for g in groups for c in g]
    return ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c for c in flat) + "\n"


_NONE = ["", "", "", ""]
WIDE = META + ",".join(_WIDE_COLUMNS) + "\n" + _wide_row(
    ['Knee "total"\nreplacement', "27447", "CPT", "K1", "CDM", "", "Outpatient", "facility", "50000", "1", "2"],
    ["20000.50", "", "", "case rate"], ["", "45", "", "fee"], ["12,5", "", "", "fee"],
) + _wide_row(
    ["Hip", "27130", "cpt", "H1", "CDM", " 52 ", "Both", "professional", "", "", ""],
    ["", "", "per contract", "fee"], _NONE, ["", " ", "", "fee"],
) + _wide_row(
    ["Other", "99999", "CPT", "O1", "CDM", "", "Both", "facility", "", "", ""], ["7", "", "", "fee"], _NONE, _NONE
)


def _payer(name, plan, methodology, **rate):
    return {"payer_name": name, "plan_name": plan, "methodology": methodology, **rate}


ITEMS = [
    {
        "description": 'Knee "total"\nreplacement',
        "code_information": [{"code": "27447", "type": "CPT"}, {"code": "K1", "type": "CDM"}, {"code": "27447", "type": "CPT"}],
        "standard_charges": [{
            "setting": "Outpatient", "billing_class": "facility", "gross_charge": 50000, "minimum": 1, "maximum": 2,
            "payers_information": [
                _payer("Aetna", "PPO", "case rate", standard_charge_dollar=20000.50),
                _payer("O'Neil", "P|1", "fee", standard_charge_percentage=45),
                _payer("Gov", "HMO", "fee", standard_charge_dollar="12,5", estimated_amount=3),
            ],
        }],
    },
    {
        "description": "Hip",
        "code_information": [{"code": "27130", "type": "cpt"}, {"code": "H1", "type": "CDM"}],
        "standard_charges": [
            {"setting": "Both", "billing_class": "professional",
             "payers_information": [_payer("Aetna", "PPO", "fee", standard_charge_algorithm="per contract")]},
            {"setting": "Both", "gross_charge": 9},
        ],
    },
    {"description": "no codes", "standard_charges": [{"setting": "x", "payers_information": [_payer("A", "B", "c")]}]},
    {"description": "no payers", "code_information": [{"code": "27447", "type": "CPT"}], "standard_charges": []},
    {
        "description": "unquoted", "code_information": [{"code": 27447, "type": "HCPCS"}],
        "standard_charges": [{"setting": "s", "payers_information": [_payer("A", "B", "c", standard_charge_dollar=5)]}],
    },
]
HEAD = {"hospital_name": "General Hospital", "last_updated_on": "2025-10-01", "version": "2.0.0", "affirmation": {"ok": True}}


def price_json(indent=None) -> str:
    return json.dumps({**HEAD, "standard_charge_information": ITEMS}, indent=indent, ensure_ascii=False)


def write(folder, name: str, text: str) -> str:
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)
