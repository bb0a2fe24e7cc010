"""The two sample tables of the report's sample mode (test inputs).

Columns: fingerprint, same_device_fingerprints, priv_base_apps, priv_var_apps,
build_type, device.  Rows are in their original order; ``rid`` is the position.
"""

REPORT_SAMPLE = [
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/oriole/oriole:12/SQ1D.220105", "['com.google.camera', 'com.google.dialer']", "['com.android.systemui']", "userdebug", "Pixel_4a"),
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/raven/raven:12/SQ1D.220205", "['com.google.messages']", "['com.android.settings', 'com.android.launcher']", "userdebug", "Pixel_4a"),
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/panther/panther:13/TQ1A.230305", "['com.google.photos', 'com.google.drive']", "['com.android.bluetooth']", "userdebug", "Pixel_4a"),
    ("google/redfin/redfin:11/RQ3A.210705", "google/oriole/oriole:12/SQ1D.220105", "['com.google.calendar']", "['com.android.wifi', 'com.android.nfc']", "userdebug", "Pixel_4a"),
    ("google/redfin/redfin:11/RQ3A.210705", "google/raven/raven:12/SQ1D.220205", "['com.google.maps', 'com.google.chrome']", "['com.android.phone']", "userdebug", "Pixel_4a"),
    ("google/bramble/bramble:11/RQ3A.210605", "google/raven/raven:12/SQ1D.220205", "['com.google.assistant']", "['com.android.contacts']", "userdebug", "Pixel_4a"),
    ("google/bramble/bramble:11/RQ3A.210605", "google/panther/panther:13/TQ1A.230305", "['com.google.translate', 'com.google.docs', 'com.google.sheets']", "['com.android.calculator', 'com.android.clock']", "userdebug", "Pixel_4a"),
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/oriole/oriole:12/SQ1D.220105", "['com.google.gmail']", "['com.android.gallery']", "user", "Pixel_4a"),
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/raven/raven:12/SQ1D.220205", "['com.google.meet']", "['com.android.music']", "user", "Pixel_4a"),
    ("google/redfin/redfin:11/RQ3A.210705", "google/oriole/oriole:12/SQ1D.220105", "['com.google.keep']", "['com.android.browser']", "user", "Pixel_4a"),
    ("google/redfin/redfin:11/RQ3A.210705", "google/panther/panther:13/TQ1A.230305", "['com.google.files']", "['com.android.email']", "user", "Pixel_4a"),
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/sunfish/sunfish:12/SQ1D.220105", "['com.google.selftest']", "['com.android.selftest']", "userdebug", "Pixel_4a"),
    ("google/catfish/catfish:11/RQ3A.999999", "google/oriole/oriole:12/SQ1D.220105", "['com.google.duplicate.app']", "['com.android.duplicate.var']", "userdebug", "Pixel_4a"),
    ("samsung/beyond/beyond1:10/QP1A.190711", "samsung/gts7/gts7xl:11/RP1A.200720", "['com.samsung.camera']", "['com.sec.android.app.launcher']", "eng", "Galaxy_S10"),
    ("samsung/canvas/canvas:10/QP1A.190711", "samsung/gts7/gts7xl:11/RP1A.200720", "['com.samsung.gallery', 'com.samsung.notes']", "['com.sec.android.app.clock']", "eng", "Galaxy_S10"),
    ("samsung/beyond/beyond1:10/QP1A.190711", "samsung/a52/a52q:11/RP1A.200720", "['com.samsung.browser']", "['com.sec.android.app.calculator']", "eng", "Galaxy_S10"),
    ("samsung/canvas/canvas:10/QP1A.190711", "samsung/a52/a52q:11/RP1A.200720", "['com.samsung.health']", "['com.sec.android.app.music']", "eng", "Galaxy_S10"),
]

INSIGHT_SAMPLE = [
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/oriole/oriole:12/SQ1D.220105", "['com.google.camera', 'com.google.dialer']", "['com.android.systemui']", "userdebug", "Pixel_4a"),
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/raven/raven:12/SQ1D.220205", "['com.google.messages']", "['com.android.settings', 'com.android.launcher']", "userdebug", "Pixel_4a"),
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/panther/panther:13/TQ1A.230305", "['com.google.photos', 'com.google.drive']", "['com.android.bluetooth']", "userdebug", "Pixel_4a"),
    ("google/redfin/redfin:11/RQ3A.210705", "google/oriole/oriole:12/SQ1D.220105", "['com.google.calendar']", "['com.android.wifi', 'com.android.nfc']", "userdebug", "Pixel_4a"),
    ("google/redfin/redfin:11/RQ3A.210705", "google/raven/raven:12/SQ1D.220205", "['com.google.maps', 'com.google.chrome']", "['com.android.phone']", "userdebug", "Pixel_4a"),
    ("google/bramble/bramble:11/RQ3A.210605", "google/raven/raven:12/SQ1D.220205", "['com.google.assistant']", "['com.android.contacts']", "userdebug", "Pixel_4a"),
    ("google/bramble/bramble:11/RQ3A.210605", "google/panther/panther:13/TQ1A.230305", "['com.google.translate', 'com.google.docs', 'com.google.sheets']", "['com.android.calculator', 'com.android.clock']", "userdebug", "Pixel_4a"),
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/oriole/oriole:12/SQ1D.220105", "['com.google.gmail']", "['com.android.gallery']", "user", "Pixel_4a"),
    ("google/sunfish/sunfish:11/RQ3A.210805", "google/raven/raven:12/SQ1D.220205", "['com.google.meet']", "['com.android.music']", "user", "Pixel_4a"),
    ("google/redfin/redfin:11/RQ3A.210705", "google/oriole/oriole:12/SQ1D.220105", "['com.google.keep']", "['com.android.browser']", "user", "Pixel_4a"),
    ("google/redfin/redfin:11/RQ3A.210705", "google/panther/panther:13/TQ1A.230305", "['com.google.files']", "['com.android.email']", "user", "Pixel_4a"),
    ("samsung/beyond/beyond1:10/QP1A.190711", "samsung/gts7/gts7xl:11/RP1A.200720", "['com.samsung.camera']", "['com.sec.android.app.launcher']", "eng", "Galaxy_S10"),
    ("samsung/canvas/canvas:10/QP1A.190811", "samsung/gts7/gts7xl:11/RP1A.200720", "['com.samsung.gallery', 'com.samsung.notes']", "['com.sec.android.app.clock']", "eng", "Galaxy_S10"),
    ("samsung/beyond/beyond1:10/QP1A.190711", "samsung/a52/a52q:11/RP1A.200820", "['com.samsung.browser']", "['com.sec.android.app.calculator']", "eng", "Galaxy_S10"),
    ("samsung/canvas/canvas:10/QP1A.190811", "samsung/a52/a52q:11/RP1A.200820", "['com.samsung.health']", "['com.sec.android.app.music']", "eng", "Galaxy_S10"),
]

SCHEMA = ("rid long, fingerprint string, same_device_fingerprints string, priv_base_apps string, "
          "priv_var_apps string, build_type string, device string")


def frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
