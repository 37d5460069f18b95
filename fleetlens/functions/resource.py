"""Endpoint metadata as resource attributes, and endpoint ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.maps import drop_empty, empty_map, literal_map, prefix_keys

# Resource attribute name -> metadata field.
RESOURCE_ATTRIBUTES = {
    "host.id": "host_id",
    "host.name": "hostname",
    "agent.id": "agent_id",
    "resource.id": "resource_id",
    "resource.kind": "kind",
    "agent.version": "agent_version",
    "endpoint.id": "endpoint_id",
    "os.type": "os",
    "os.version": "os_version",
    "platform": "platform",
    "platform.family": "platform_family",
    "platform.version": "platform_version",
    "arch": "architecture",
    "kernel.version": "kernel_version",
    "kernel.architecture": "kernel_architecture",
    "cloud.provider": "cloud_provider",
    "cloud.region": "region",
    "cloud.zone": "availability_zone",
    "cloud.account.id": "account_id",
    "cloud.project.id": "project_id",
    "cloud.instance.id": "instance_id",
    "cloud.instance.type": "instance_type",
    "cloud.resource.group": "resource_group",
    "cloud.vpc.id": "vpc_id",
    "cloud.subnet.id": "subnet_id",
    "cloud.image.id": "image_id",
    "cloud.service.id": "service_id",
    "container.id": "container_id",
    "container.name": "container_name",
    "container.image.id": "container_image_id",
    "container.image.name": "container_image_name",
    "k8s.pod.name": "pod_name",
    "k8s.namespace.name": "namespace",
    "k8s.cluster.name": "cluster_name",
    "k8s.node.name": "node_name",
    "application": "application",
    "service.name": "service",
    "service.version": "version",
    "environment": "environment",
    "deployment.id": "deployment_id",
    "host.ip": "ip_address",
    "host.public_ip": "public_ip",
    "host.private_ip": "private_ip",
    "host.mac": "mac_address",
    "network.interface": "network_interface",
}

META_FIELDS = list(RESOURCE_ATTRIBUTES.values()) + ["virtualization_system", "virtualization_role"]

# Attributes the payload itself identifies; they beat the metadata.
PAYLOAD_IDENTITY = {
    "host.id": "host_id",
    "agent.id": "agent_id",
    "host.name": "hostname",
    "endpoint.id": "endpoint_id",
}


def meta_struct(columns: dict[str, Column], tags: Column | None = None) -> Column:
    """A full metadata struct; fields that are not given are null."""
    unknown = set(columns) - set(META_FIELDS)
    if unknown:
        raise ValueError(f"unknown metadata fields: {sorted(unknown)}")
    none = F.lit(None).cast("string")
    fields = [columns.get(f, none).cast("string").alias(f) for f in META_FIELDS]
    return F.struct(*fields, (empty_map() if tags is None else tags).alias("tags"))


def resource_attributes(meta: Column, compat: bool = False) -> Column:
    """Metadata as an attribute map: empty values dropped, tags as ``tag.*``.

    ``compat`` leaves the tags out.
    """
    fixed = literal_map({name: meta[field] for name, field in RESOURCE_ATTRIBUTES.items()})
    if compat:
        return F.coalesce(drop_empty(fixed), empty_map())
    tags = F.map_filter(F.coalesce(meta["tags"], empty_map()), lambda k, v: v != "")
    return F.map_concat(drop_empty(fixed), prefix_keys(tags, "tag."))


def payload_resource(identity: dict[str, Column], meta: Column, compat: bool = False) -> Column:
    """Attributes of a log payload: its own identity first, metadata for the rest."""
    own = literal_map({name: identity[field] for name, field in PAYLOAD_IDENTITY.items()})
    rest = F.map_filter(
        resource_attributes(meta, compat), lambda k, v: ~k.isin(*PAYLOAD_IDENTITY)
    )
    return F.map_concat(drop_empty(own), rest)


def endpoint_id(kind: Column, host_id: Column, container_id: Column | None = None) -> Column:
    """Stable id of a host or of a container on a host."""
    container = F.lit("") if container_id is None else F.coalesce(container_id, F.lit(""))
    return F.sha2(F.concat_ws("|", kind, F.coalesce(host_id, F.lit("")), container), 256)
