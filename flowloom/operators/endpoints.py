"""Link, network and transport layer offsets and the two endpoints of a packet.

Only the first bytes of a packet are looked at, with JVM expressions, so this
runs on every packet before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.bytefields import hex_at, ipv4_text, ipv6_text, uint_at

# Link types, EtherTypes and protocol numbers.
LINK_ETHERNET = 1
# Bytes ahead of the network header by link type, where there is no VLAN tag:
# raw IP and its aliases, loopback with an address family, two forms of Linux cooked captures.
LINK_BYTES = {12: 0, 101: 0, 228: 0, 229: 0, 0: 4, 108: 4, 113: 16, 276: 20}
VLAN_TYPES = ("8100", "88A8")
ETHERTYPE_IPV4 = "0800"
ETHERTYPE_IPV6 = "86DD"
TCP = 6
UDP = 17

# IPv6 headers ahead of the transport header: hop-by-hop, routing, destination options, mobility (all
# counted in units of eight bytes beyond the first), authentication (units of four, beyond two) and fragment.
IPV6_OPTIONS = (0, 43, 60, 135)
IPV6_AUTHENTICATION = 51
IPV6_FRAGMENT = 44
IPV6_CHAIN = (*IPV6_OPTIONS, IPV6_AUTHENTICATION, IPV6_FRAGMENT)

# Two VLAN tags, the longest IPv4 header and the ports fit in this many bytes.
_LOOKAHEAD = 22 + 60 + 4
# IPv6 headers that are followed at most, and the bytes they are looked for in.
_CHAIN_STEPS = 6
_CHAIN_BYTES = 190
# Ports that lie beyond these first bytes of a packet are not looked for.
HEAD_BYTES = 256
_LATER_FRAGMENT = -1


def _behind_headers(proto: Column, x: Column) -> Column:
    """``proto`` and place ``at`` behind the IPv6 headers in the hex digits ``x``, the first of which ``proto`` names.

    A fold, so that what few packets have takes little room in the code that runs for all.
    """
    state = "struct<proto:int,at:int>"

    def step(acc: Column, _: Column) -> Column:
        known, at = acc["proto"], acc["at"]
        units = uint_at(x, at + 1, 1)
        size = F.when(known == IPV6_FRAGMENT, 8).when(known == IPV6_AUTHENTICATION, (units + 2) * 4).otherwise((units + 1) * 8)
        # The upper 13 bits tell where a fragment lies; only the first one has ports.
        later = (known == IPV6_FRAGMENT) & (uint_at(x, at + 2, 2) >= 8)
        onward = F.struct(
            F.when(later, _LATER_FRAGMENT).otherwise(uint_at(x, at, 1)).cast("int").alias("proto"), (at + size).cast("int").alias("at")
        )
        return F.when(known.isin(*IPV6_CHAIN), onward.cast(state)).otherwise(acc)

    begin = F.struct(proto.alias("proto"), F.lit(0).alias("at")).cast(state)
    return F.aggregate(F.sequence(F.lit(1), F.lit(_CHAIN_STEPS)), begin, step)


def with_endpoints(packets: DataFrame) -> DataFrame:
    """Add ``vlan_tags, ip_version, ip0, l4, proto, src_ip, src_port, dst_ip, dst_port``.

    ``ip0`` and ``l4`` are byte offsets of the network and transport headers. IPv6 headers between
    the two are followed from one to the next; ``proto`` is what the last one names.
    ``l4`` and the ports are null for anything but TCP and UDP, and for later fragments.
    """
    h, ip0, tags = F.col("_h"), F.col("ip0"), F.col("vlan_tags")
    proto, l4 = F.col("proto"), F.col("l4")
    v4, v6 = F.col("ip_version") == 4, F.col("ip_version") == 6
    link = F.col("linktype") if "linktype" in packets.columns else F.lit(LINK_ETHERNET)
    ethernet = link == LINK_ETHERNET
    tag1 = ethernet & hex_at(h, 12, 2).isin(*VLAN_TYPES)
    tag2 = tag1 & hex_at(h, 16, 2).isin(*VLAN_TYPES)
    # One byte of the network header decides; Ethernet names the same protocol before it.
    version = hex_at(h, ip0, 1).substr(1, 1)
    network = F.when(ethernet, F.concat(hex_at(h, ip0 - 2, 2), version)).otherwise(version)
    ahead = F.create_map(*[F.lit(x) for pair in LINK_BYTES.items() for x in pair])
    offset_bits = uint_at(h, ip0 + 6, 2).bitwiseAND(0x1FFF)
    ihl = (uint_at(h, ip0, 1).bitwiseAND(15) * 4).cast("int")
    carried = proto.isin(TCP, UDP) & (v6 | (offset_bits == 0))
    ended = (
        packets.withColumn("_h", F.hex(F.substring("data", 1, _LOOKAHEAD)))
        .withColumn("vlan_tags", F.when(tag2, 2).when(tag1, 1).otherwise(0))
        .withColumn("ip0", F.when(ethernet, tags * 4 + 14).otherwise(F.try_element_at(ahead, link)))
        .withColumn(
            "ip_version",
            F.when(network.isin("4", ETHERTYPE_IPV4 + "4"), 4).when(
                network.isin("6", ETHERTYPE_IPV6 + "6"), 6
            ),
        )
        .withColumn("proto", uint_at(h, F.when(v4, ip0 + 9).when(v6, ip0 + 6), 1).cast("int"))
        .withColumn("_src", F.when(v4, ip0 + 12).when(v6, ip0 + 8))
        .withColumn("_x", F.when(v6 & proto.isin(*IPV6_CHAIN), F.hex(F.substring("data", ip0 + 41, F.lit(_CHAIN_BYTES)))))
        .withColumn("_behind", F.when(F.col("_x").isNotNull(), _behind_headers(proto, F.col("_x"))))
        .withColumn("proto", F.when(F.col("_x").isNotNull(), F.col("_behind.proto")).otherwise(proto))
        .withColumn("l4", F.when(carried, ip0 + F.when(v6, F.coalesce("_behind.at", F.lit(0)) + 40).otherwise(ihl)))
        # A packet cut off before its ports has no transport header for us.
        .withColumn("l4", F.when(F.least(F.octet_length("data"), F.lit(HEAD_BYTES)) >= l4 + 4, l4))
        .withColumn("_p", F.hex(F.substring("data", l4 + 1, F.lit(4))))
    )
    src = F.col("_src")
    decoded = F.struct(
        "vlan_tags",
        "ip_version",
        "ip0",
        "l4",
        "proto",
        F.when(v4, ipv4_text(h, src)).when(v6, ipv6_text(h, src)).alias("src_ip"),
        uint_at(F.col("_p"), 0, 2).cast("int").alias("src_port"),
        F.when(v4, ipv4_text(h, src + 4)).when(v6, ipv6_text(h, src + 16)).alias("dst_ip"),
        uint_at(F.col("_p"), 2, 2).cast("int").alias("dst_port"),
    )
    # Filters on the decoded columns stay above the generator. Pushed below it, they would
    # spell out the whole decoding once more for every mention of a column.
    return ended.select(*packets.columns, F.inline(F.array(decoded)))


def flow_key(
    src_ip: Column, src_port: Column, dst_ip: Column, dst_port: Column, proto: Column
) -> Column:
    """``a-b-port_a-port_b-proto`` with the lower (address, port) first: same both ways."""
    src = F.struct(src_ip.alias("ip"), src_port.cast("int").alias("port"))
    dst = F.struct(dst_ip.alias("ip"), dst_port.cast("int").alias("port"))
    low, high = F.least(src, dst), F.greatest(src, dst)
    return F.concat_ws(
        "-",
        low["ip"],
        high["ip"],
        low["port"].cast("string"),
        high["port"].cast("string"),
        proto.cast("string"),
    )


def is_forward(src_ip: Column, src_port: Column, dst_ip: Column, dst_port: Column) -> Column:
    """True when the packet goes from the lower to the higher endpoint."""
    return F.struct(src_ip.alias("ip"), src_port.alias("port")) <= F.struct(
        dst_ip.alias("ip"), dst_port.alias("port")
    )
