"""The seven standard CRM objects. Fixed values; pass specs of your own for other sources."""

from changevault.model import ObjectSpec, PartitionBy

_BY_DAY = PartitionBy("SystemModstamp", "day")

STANDARD_OBJECTS = (
    ObjectSpec("Account", partition_by=(_BY_DAY,)),
    ObjectSpec("Contact", partition_by=(_BY_DAY,), exclude_fields=("PhotoUrl", "IndividualId")),
    ObjectSpec("Opportunity", partition_by=(_BY_DAY, PartitionBy("StageName", "identity"))),
    ObjectSpec("Lead", partition_by=(_BY_DAY,), overflow=True, exclude_fields=("PhotoUrl",)),
    ObjectSpec("Case", partition_by=(_BY_DAY,), removed_field_policy="halt"),
    ObjectSpec("Task", partition_by=(_BY_DAY,), overflow=True),
    ObjectSpec("Event", partition_by=(_BY_DAY,), removed_field_policy="halt"),
)
