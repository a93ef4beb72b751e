"""Role specification: the one piece of configuration everything is parameterised by.

The master table carries three repeated contact groups side by side.  Each
role maps the long-table field names to the master column names, and to the
column names used by the per-role derived views ("analysis" and "details").
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RoleSpec:
    role: str
    client_col: str  # client column name in the role's derived tables
    name: str
    designation: str
    email: str
    phone: str
    location: str
    response: str
    # master columns the dashboard title-cases on this role's analysis table
    titled_fields: tuple[str, ...]

    def master_cols(self) -> dict[str, str]:
        """long-table field -> master column"""
        return {
            "name": self.name,
            "designation": self.designation,
            "email": self.email,
            "phone": self.phone,
            "location": self.location,
            "contact_response": self.response,
        }


# Master column names of each contact group (must equal the reference's schema).
ROLES: dict[str, RoleSpec] = {
    "tax": RoleSpec("tax", "Client_Name", "Tax_Contact", "Designation", "Email_ID",
                    "Phone_Number", "Location", "Response_1",
                    ("client", "Practice_Head", "Partner", "Sector", "location")),
    "cfo": RoleSpec("cfo", "Company_Name", "CFO_Name", "Designation_2", "Email_ID_3",
                    "Phone_Number_4", "Location_6", "Response_7",
                    ("Practice_Head", "Partner", "Sector")),
    "other": RoleSpec("other", "Company_Name", "Others", "Designation_8", "Email_ID_9",
                      "Phone_Number_10", "Location_12", "Response_13",
                      ("Practice_Head", "Partner", "Sector")),
}

ROLE_ORDER = ("tax", "cfo", "other")

# Client-level attributes copied onto every contact row.
CLIENT_ATTRS = ("Practice_Head", "Partner", "Sector", "Response", "numInvitees",
                "numRegistrations", "Invite_Status")

# Long contacts table columns, in order.
CONTACT_COLS = ("role", "id", "client") + CLIENT_ATTRS + (
    "name", "designation", "email", "phone", "location", "contact_response")

# Per-role analysis view: (derived column, long-table field); client/name/... resolved per role.
ANALYSIS_FIELDS = ("client", "Practice_Head", "Partner", "Invite_Status", "numInvitees", "Response",
                   "Sector", "numRegistrations", "name", "designation", "email", "phone",
                   "location", "contact_response")
DETAILS_FIELDS = ("client", "numRegistrations", "name", "designation", "email", "phone",
                  "contact_response")


def derived_name(spec: RoleSpec, field: str) -> str:
    """Name of a long-table field inside the role's derived table."""
    if field == "client":
        return spec.client_col
    return spec.master_cols().get(field, field)
