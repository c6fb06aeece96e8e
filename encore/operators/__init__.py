"""Batch jobs as DataFrame functions.

* ``content``  catalog cleaning (J2), song features (J3, one day / a range /
  from sketches), song and singer popularity rankings (J4, J5)
* ``machine``  machine profile from two systems (J6)
* ``location`` + ``geo``  modal machine location and nearest-place join (J7)
* ``users``    consumption brief (J8), active profiles and lists (J9)
* ``revenue``  machine, region and merchant revenue (J10-J12)
* ``ranking``, ``small``  ranking / mode helpers, lookup helpers
"""
