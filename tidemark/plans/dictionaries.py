"""Command dictionaries and other fixed values of the ledger domain."""

from __future__ import annotations

import hashlib
import re

# --- Fixed values: program ids -------------------------------------------------------------------------------
TOKEN_PROGRAM = "TokenkegQfeZyiNwAJbNbGKPFXCWuBvf9Ss623VQ5DA"
ASSOCIATED_TOKEN_PROGRAM = "ATokenGPvbdGVxr1b2hvZbsiqW5xWH25efTNsLJA8knL"
METADATA_PROGRAM = "metaqbxxUerdq28cj1RbAWkYQm3ybzjb6a8bt518x1s"
NAME_PROGRAM = "namesLPneVptA9Z5rqUDD9tMTWEJwofgaYwp8cawRkX"
BONDING_PROGRAM = "TBondmkCYxaPCKG4CHYfVTcwQ8on31xnJrPzk8F8WsS"
COLLECTIVE_PROGRAM = "TCo1sfSr2nCudbeJPykbif64rG9K1JNMGzrtzvPmp3y"

# --- Fixed values: argument layouts (field order and types are the programs' wire format) ---------------------
_CREATOR = {"struct": [["address", "pubkey"], ["verified", "u8"], ["share", "u8"]]}
_NAMED = [["name", "string"], ["symbol", "string"], ["uri", "string"], ["sellerFeeBasisPoints", "u16"],
          ["creators", {"option": {"vec": _CREATOR}}]]
_DATA = {"struct": _NAMED}
_DATA_V2 = {"struct": _NAMED + [
    ["collection", {"option": {"struct": [["verified", "u8"], ["key", "pubkey"]]}}],
    ["uses", {"option": {"struct": [["useMethod", "u8"], ["total", "u64"], ["remaining", "u64"]]}}],
]}

# --- Fixed values: program, opcode, event type, ordered account names, argument layout -----------------------
_COMMANDS = [
    (ASSOCIATED_TOKEN_PROGRAM, 0, "InitializeAssociatedTokenAccount", "signer account owner mint", None),
    (TOKEN_PROGRAM, 1, "InitializeTokenAccount", "account mint owner", []),
    (TOKEN_PROGRAM, 6, "TokenProgramSetAuthority", "mintOrAccount signer1",
     [["authorityType", "u8"], ["newAuthority", {"option": "pubkey"}]]),
    (METADATA_PROGRAM, 0, "CreateMetadata", "tokenMetadata mint mintAuthority payer updateAuthority",
     [["data", _DATA], ["isMutable", "u8"]]),
    (METADATA_PROGRAM, 1, "UpdateMetadata", "tokenMetadata updateAuthority",
     [["data", {"option": _DATA}], ["updateAuthority", {"option": "pubkey"}],
      ["primarySaleHappened", {"option": "u8"}]]),
    (METADATA_PROGRAM, 16, "CreateMetadataV2", "tokenMetadata mint mintAuthority payer updateAuthority",
     [["data", _DATA_V2], ["isMutable", "u8"]]),
    (METADATA_PROGRAM, 15, "UpdateMetadataV2", "tokenMetadata updateAuthority",
     [["data", {"option": _DATA_V2}], ["updateAuthority", {"option": "pubkey"}],
      ["primarySaleHappened", {"option": "u8"}], ["isMutable", {"option": "u8"}]]),
    (NAME_PROGRAM, 0, "CreateNameServiceName", "systemProgram payer name owner class parent parentOwner",
     [["hashedName", "pubkey"], ["lamports", "u64"], ["space", "u32"]]),
    (NAME_PROGRAM, 1, "UpdateNameServiceName", "name ownerOrClass", [["offset", "u32"], ["data", {"vec": "u8"}]]),
    (NAME_PROGRAM, 2, "TransferNameServiceName", "name owner class", [["newOwner", "pubkey"]]),
    (NAME_PROGRAM, 3, "DeleteNameServiceName", "name owner refund", []),
]

# --- Fixed values: early-user award ---------------------------------------------------------------------------
AWARD_NAME = "alpha_tester"
AWARD_META = "6xEXbyeLFzKqq7mHy28vyp6xR6bRU6m72hZvrgzNJeK7"
AWARD_CUTOFF_MILLIS = 1632766320000
AWARD_EXCLUDED = [
    "8dPK9fYnbw1nLAHvcRUmXBh9mVmoWtsBFHi72GP2CnT9",
    "HnK4B6JA82TBBFPCTE2FJJeSZBhCPrzzV9KeRDQxiBeE",
    "CvaNBgnjXx7hbLGceUAnsgN4Lb7WNusLCaLFqfczDzp4",
    "H8FeC5b7PgvgF9wn68UoZ6PzdP8xvyw9X7YkxEbL2GTc",
    "AxkpbnNGf3fJ6EqPExxLgBVbx3LAGV4m3BqisgVbEv2Y",
    "3SawFRYytB9yhGiKYLgXasxQgNFcBvG4RdC1o4ppYckY",
    "AtcCpUDMufFZRytcfBbyzQgNGpRqCJWd8X5cPReZWGSX",
    "29dx5KPPi2DLdoQ9eEaTLrhCDQaHHLJo7LaX7SzGgzyg",
    "JUskoxS2PTiaBpxfGaAPgf3cUNhdeYFGMKdL6mZKKfR",
    "5K51fPDxJho82SVUTP2e1NUFkweHD4PawJWYVACrMtYg",
    "Gzyvrg8gJfShKQwhVYFXV5utp86tTcMxSzrN7zcfebKj",
    "44kiGWWsSgdqPMvmqYgTS78Mx2BKCWzduATkfY4biU97",
    "5BwQHT3WzZJBqAHR8tDt9UWMVpkoJ3rLHpuhUYUf57r7",
    "Gf4EWrvgqeuyszbhsq2mTMooGJ6zsMB7f1CSnZZ8vvSV",
    "6JmbM2MuB18qJyZrQC7QPHdYFV2e8YecQYYEaihNJZ3T",
]

# --- Fixed values: block errors worth a retry, request command and replies ------------------------------------
RETRIABLE_ERRORS = ["%Block not available%", "%cleaned up, does not exist on node%"]
OPT_OUT_COMMAND = "OPT OUT"
OPT_OUT_DONE = "Opt Out Successful! We're sorry to see you go."


def opcode_commands() -> list[dict]:
    """Commands selected by the first data byte; the opcode itself is read as the field ``instruction``."""
    return [
        {
            "programId": program, "key": f"{opcode:02x}", "type": name, "accounts": accounts.split(), "skip": 0,
            "layout": None if fields is None else {"struct": [["instruction", "u8"], *fields]}, "strict": True,
        }
        for program, opcode, name, accounts, fields in _COMMANDS
    ]


def idl_commands(idl: dict, program_id: str | None = None) -> list[dict]:
    """Commands of a program described by an interface definition, selected by an 8-byte discriminator."""
    types = {t["name"]: t["type"] for t in idl.get("types", [])}
    address = program_id or idl["metadata"]["address"]
    return [
        {
            "programId": address, "key": discriminator(ix["name"]), "type": ix["name"],
            "accounts": account_paths(ix["accounts"]), "skip": 8, "strict": False,
            "layout": {"struct": [[camel(a["name"]), layout_of(a["type"], types)] for a in ix["args"]]},
        }
        for ix in idl.get("instructions", [])
    ]


def discriminator(instruction: str) -> str:
    snake = re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", instruction).lower()
    return hashlib.sha256(f"global:{snake}".encode()).digest()[:8].hex()


def account_paths(items: list[dict], prefix: str = "") -> list[str]:
    """Dotted leaf names of a possibly nested account list, left to right."""
    paths: list[str] = []
    for item in items:
        path = prefix + item["name"]
        paths += account_paths(item["accounts"], path + ".") if "accounts" in item else [path]
    return paths


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head[:1].lower() + head[1:] + "".join(part.capitalize() for part in rest)


def layout_of(kind, types: dict):
    """An interface type as a reader layout, with defined types written out."""
    if isinstance(kind, str):
        return "pubkey" if kind == "publicKey" else kind
    if "defined" in kind:
        return layout_of(types[kind["defined"]], types)
    if "kind" in kind:
        if kind["kind"] == "struct":
            return {"struct": [[camel(f["name"]), layout_of(f["type"], types)] for f in kind["fields"]]}
        return {"enum": [
            [camel(v["name"]), [[camel(f["name"]), layout_of(f["type"], types)] for f in v.get("fields", [])]]
            for v in kind["variants"]
        ]}
    (form, inner), = kind.items()
    return {form: [layout_of(inner[0], types), inner[1]] if form == "array" else layout_of(inner, types)}
